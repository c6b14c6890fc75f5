"""Sheets of cells to typed records, one family of workbooks at a time.

A family is data: its labels, the fields it must have, how each field is typed,
and which field names a record.  Reading gives ``(records, review)``: nothing is
dropped without a reason, and no column outside the closed list is read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, emails, numbers, phones, status
from ..functions.text import cell_text, customer_codes, sensitive
from . import headers
from .headers import SHEET


@dataclass(frozen=True)
class Family:
    words: Mapping[str, Sequence[str]]
    required: Sequence[str]
    key: str
    types: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    least: int = 3
    sections: bool = False
    header_rows: int = 30

    @property
    def fields(self) -> list[str]:
        return list(self.words)


def _amount(c: Column) -> Column:
    return numbers.money(numbers.parse_number(c))


def _quantity(c: Column) -> Column:
    return numbers.parse_number(c).cast("decimal(18,4)")


def _yes_no(c: Column) -> Column:
    """Yes, no or unknown."""
    return F.when(F.lower(c).isin("y", "yes", "是", "1"), True).when(F.lower(c).isin("n", "no", "否", "0"), False)


#: Labels of each family's sheets; ``=`` asks for the whole label.
FAMILIES: dict[str, Family] = {
    "orders": Family(
        {"document_no": ["document no", "order no", "单据编号", "belegnummer"], "date": ["document date", "order date", "单据日期", "belegdatum"], "customer": ["=customer", "客户", "kunde"], "salesperson": ["salesperson", "业务员"],
         "status": ["order status", "=status", "单据状态"], "product_code": ["product code", "料号", "artikelnummer"], "product_name": ["product name", "品名"], "quantity": ["sales quantity", "quantity", "数量", "menge"],
         "net": ["amount excl", "net amount", "未税金额", "nettobetrag"], "tax": ["tax amount", "税额"], "gross": ["amount incl", "gross amount", "含税金额", "bruttobetrag"]},
        ["document_no", "date", "customer"], "document_no", {"date": dates.order_date, "quantity": _quantity, "net": _amount, "tax": _amount, "gross": _amount, "status": lambda c: status.state_of(c, status.ORDER_STATES, "other")}, least=5,
    ),
    "receivables": Family(
        {"customer_en": ["customer name(en)"], "customer": ["=customer name"], "invoice_no": ["sales invoice no", "invoice no"], "invoice_date": ["invoice date"], "due": ["due date"], "amount": ["invoice value", "amount"]},
        ["invoice_no", "due", "amount"], "invoice_no", {"invoice_date": dates.order_date, "due": dates.order_date, "amount": _amount}, least=4,
    ),
    "quotes": Family(
        {"quote_no": ["quote #"], "company": ["=company"], "rfq": ["rfq date"], "quoted": ["quote date"], "quantity": ["=qty"], "price": ["sales price"], "total": ["total sales volume"], "state": ["status sales chance"], "remark": ["follow up remark"]},
        ["quote_no", "company", "price", "state"], "quote_no",
        {"rfq": dates.order_date, "quoted": dates.order_date, "quantity": lambda c: numbers.money(numbers.parse_number(c)), "price": _amount, "total": _amount, "state": lambda c: status.state_of(c, status.QUOTE_STATES, "unknown")}, least=4, header_rows=1,
    ),
    "todos": Family(
        {"no": ["=no.", "=no"], "category": ["categor"], "date": ["=date"], "topic": ["topic"], "step": ["to do", "next step"], "responsible": ["responsible"], "due": ["due date", "deadline"], "state": ["status"], "priority": ["prio"], "remark": ["remark"]},
        ["topic", "due"], "topic", {"date": dates.order_date, "due": dates.order_date, "state": lambda c: status.todo_state(c)["state"]}, least=4,
    ),
    "accounts": Family(
        {"code": ["customer code", "客户编码"], "cn": ["cn name", "客户名称"], "en": ["en name"], "province": ["province", "省直辖市"], "region": ["region", "地区名称"], "industry": ["industr", "所属行业"], "address": ["address", "地址"],
         "phone": ["phone", "电话"], "email": ["email"], "first_order": ["first order"], "existing": ["existing"]},
        ["code", "cn"], "cn", {"code": lambda c: F.coalesce(customer_codes(c)[0], c), "phone": phones.phone_e164, "email": lambda c: emails.addresses(c)[0], "first_order": dates.first_order, "existing": _yes_no}, least=3, sections=True,
    ),
    "contacts": Family(
        {"company": ["公司名称", "=company"], "person": ["联系人", "contact person"], "phone": ["电话", "phone no"], "email": ["e-mail", "email"], "position": ["position"], "address": ["地址", "address"], "remark": ["remark"]},
        ["person"], "person", {"phone": phones.phone_e164, "email": lambda c: emails.addresses(c)[0]}, least=3, sections=True,
    ),
    "visits": Family(
        {"sales": ["=sales"], "week": ["=cw"], "date": ["=date"], "city": ["location"], "customer": ["customer (full", "=customer"], "kind": ["customer (new"], "potential": ["potential"], "person": ["contact name", "=name"], "phone": ["phone"],
         "email": ["email"], "purpose": ["purpose"], "step": ["next step"], "due": ["due date", "deadline"], "state": ["status"]},
        ["date", "customer"], "customer", {"phone": phones.phone_e164}, least=4,
    ),
}


def labelled(cells: DataFrame, family: Family) -> DataFrame:
    """Headers of a family in ``cells``."""
    words = headers.synonyms(cells.sparkSession, family.words)
    return headers.find_headers(cells, words, family.least, family.required, not family.sections, family.header_rows)


def read(cells: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``(records, review)`` of one family: typed fields with ``file, sheet, row, issues, extra``; and the rows and values that need a look."""
    return parted(rows_read(cells, name), name)


def rows_read(cells: DataFrame, name: str) -> DataFrame:
    """Every row below a header with its typed fields, ``unread`` values, ``reason`` (null for a record) and ``extra``: what :func:`parted` parts, and what to store where both parts are wanted."""
    family = FAMILIES[name]
    tidy = cells.withColumn("text", cell_text(F.col("text")))
    found = labelled(tidy, family)
    raw = headers.skip_reasons(headers.pivoted(tidy, found, family.fields), family.key, family.fields)
    raw = raw.join(headers.extras(tidy, found), [*SHEET, "row"], "left")
    unread = [F.when(F.col(f).isNotNull() & family.types[f](F.col(f)).isNull(), F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for f in family.types]
    held = F.array_compact(F.array(*unread)) if unread else F.array().cast("array<struct<field:string,value:string>>")
    typed = [family.types[f](F.col(f)).alias(f) if f in family.types else F.col(f) for f in family.fields]
    return raw.withColumn("unread", held).select(*SHEET, "row", *typed, "unread", "reason", "extra")


def parted(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``(records, review)`` of the rows that :func:`rows_read` gives."""
    records = rows.where("reason is null").select(*SHEET, "row", *FAMILIES[name].fields, F.transform("unread", lambda u: u["field"]).alias("issues"), "extra")
    line = lambda df, f, v, why: df.select(*SHEET, "row", f.alias("field"), v.alias("value"), why.alias("reason"))
    skipped = line(rows.where("reason is not null"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("reason"))
    values = rows.where("reason is null").select(*SHEET, "row", F.explode("unread").alias("u"))
    return records, skipped.unionByName(line(values, F.col("u.field"), F.col("u.value"), F.lit("unreadable value")))


def unread_labels(cells: DataFrame, name: str) -> DataFrame:
    """``file, sheet, label``: labels of a header row that stand for no field; sensitive ones are named, never their values."""
    found = labelled(cells, FAMILIES[name])
    top = found.select(*SHEET, "header_row").distinct()
    labels = cells.join(top, list(SHEET)).where("row = header_row and text is not null")
    return labels.join(found.select(*SHEET, "col"), [*SHEET, "col"], "left_anti").select(*SHEET, F.col("text").alias("label"), sensitive(F.col("text")).alias("sensitive"))


def classify(cells: DataFrame) -> DataFrame:
    """``file, family``: the family that at least half of a workbook's sheets look like; orders and receivables first."""
    order = list(FAMILIES)
    seen = None
    for k, name in enumerate(order):
        part = labelled(cells, FAMILIES[name]).select(*SHEET).distinct().withColumn("family", F.lit(name)).withColumn("rank", F.lit(k))
        seen = part if seen is None else seen.unionByName(part)
    per_sheet = seen.groupBy(*SHEET).agg(F.min_by("family", "rank").alias("family"), F.min("rank").alias("rank"))
    sheets = cells.groupBy("file").agg(F.count_distinct("sheet").alias("sheets"))
    votes = per_sheet.groupBy("file", "family", "rank").agg(F.count("*").alias("n")).join(sheets, "file")
    wins = votes.where((F.col("rank") < 2) | (2 * F.col("n") >= F.col("sheets")))
    best = wins.groupBy("file").agg(F.min_by("family", F.struct(F.when(F.col("rank") < 2, F.col("rank")).otherwise(2).alias("first"), (-F.col("n")).alias("n"), "rank")).alias("family"))
    return sheets.join(best, "file", "left").select("file", F.coalesce("family", F.lit("unrecognised")).alias("family"))


def visits(cells: DataFrame, year: Column, owner_label: str = "owner") -> tuple[DataFrame, DataFrame]:
    """Visit blocks of weekly sheets: ``(visits, review)``.

    A row with a customer or a date of its own starts a visit and the rows below
    belong to it: their steps become ordered notes, each with its due date.
    Dates without a year take ``year``; a due date is counted from the visit.
    """
    family = FAMILIES["visits"]
    tidy = cells.withColumn("text", cell_text(F.col("text")))
    rows = headers.pivoted(headers_resolved_text(tidy), labelled(tidy, family), family.fields)
    own = headers.pivoted(tidy, labelled(tidy, family), ["date", "customer"]).select(*SHEET, "row", F.col("date").alias("own_date"), F.col("customer").alias("own_customer"))
    rows = rows.join(own, [*SHEET, "row"], "left")
    order = Window.partitionBy(*SHEET).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.col("own_customer").isNotNull()
    rows = rows.withColumn("block", F.sum(F.when(starts, 1).otherwise(0)).over(order)).where("block > 0")
    read = F.coalesce(dates.visit_date(F.col("date"), year), dates.general_date(F.col("date"), F.make_date(year, F.lit(7), F.lit(1)), year)["day"])
    note = F.when(F.coalesce("step", "due").isNotNull(), F.struct("row", F.col("step").alias("text"), F.col("due").alias("due")))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row")))
    keep = [f for f in family.fields if f not in ("step", "due", "date", "purpose")]
    out = rows.withColumn("day", read).groupBy(*SHEET, "block").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.min_by("day", F.when(F.col("day").isNotNull(), F.col("row"))).alias("day"), F.min_by("date", F.when(F.col("date").isNotNull(), F.col("row"))).alias("date_text"),
        *[first(f).alias(f) for f in keep], F.array_sort(F.collect_list(note)).alias("notes"), F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.when(F.col("purpose").isNotNull(), F.struct("row", "purpose")))), lambda p: p["purpose"])).alias("purpose"),
    )
    dated = lambda n: F.coalesce(dates.decimal_due(n["due"], F.col("day")), dates.general_date(n["due"], F.col("day"))["day"], dates.deadline(F.coalesce(n["due"], n["text"]), F.col("day")))
    out = out.withColumn("notes", F.transform("notes", lambda n: F.struct(n["row"].alias("row"), n["text"].alias("text"), dated(n).alias("due"))))
    owners = headers.beside(tidy, owner_label).withColumnRenamed("value", "owner")
    out = out.join(owners, list(SHEET), "left").withColumn("owner", F.coalesce("sales", "owner"))
    out = out.withColumn("visit_id", F.concat_ws(":", F.lower(F.coalesce("owner", F.lit(""))), F.coalesce(F.col("day").cast("string"), "date_text", F.lit("")), F.lower(F.regexp_replace("customer", "[^\\p{L}\\p{N}]", ""))))
    reasons = F.array_compact(F.array(F.when(F.col("day").isNull(), "no date"), F.when(F.col("owner").isNull(), "no owner"), F.when(F.col("customer").isNull(), "no customer")))
    out = out.withColumn("reasons", reasons)
    return out.where(F.size("reasons") == 0).drop("reasons"), out.where(F.size("reasons") > 0).select(*SHEET, F.col("first_row").alias("row"), "customer", F.explode("reasons").alias("reason"))


def headers_resolved_text(cells: DataFrame) -> DataFrame:
    """Cells with merged areas filled, if the table knows merges."""
    return headers.resolved(cells).drop("continued") if "merge_row" in cells.columns else cells
