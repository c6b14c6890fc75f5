"""Business papers as text: what kind, their fields, their line items, and whether the sums agree.

A kind is data: words it must hold, patterns of its fields, and how its line items
end.  Items are found line by line: a line that begins an item opens a segment, the
first line that carries the item's figures closes it, and what stands between is one
description, however often it wraps.  Where figures stand under a header, cells are cut
at the places of its labels.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = r"([\d,]+\.\d{2})"
YEN = "[¥￥]"


@dataclass(frozen=True)
class Items:
    """``begins``: how an item's first line starts; ``figures``: its figures, the named groups in the order of ``names``, at the end of its last line; ``ends``: the line behind the last item."""

    begins: str
    figures: str
    names: Sequence[str]
    ends: str


@dataclass(frozen=True)
class Kind:
    marks: Sequence[str]
    fields: Mapping[str, Sequence[str]] = field(default_factory=dict)
    needs: Sequence[str] = ()
    items: Items | None = None


#: The words, labels and number formats of four kinds of paper, in the order in which they are tried.  Of several patterns of a field the first that fits counts.
KINDS: dict[str, Kind] = {
    "order_confirmation": Kind(
        ["Order Confirmation|Order NO"],
        {
            "number": [r"Order NO\.?\s*[:：]?\s*(SO\d{7})"],
            "date": [r"Date\s*[:：]?\s*(\d{4}-\d{2}-\d{2})"],
            "customer_no": [r"Customer No\.?\s*[:：]?\s*(\S+)"],
            "contact": [r"Contact Person\s*[:：]?\s*([^\n]+?)\s*(?:\n|Tel)"],
            "net": [rf"Net Value\s*[:：]?\s*{MONEY}"],
            "vat": [rf"VAT\s*[:：]?\s*{MONEY}"],
            "total": [rf"Total Value\s*[:：]?\s*{MONEY}"],
            "payment_terms": [r"Terms of payment\s*[:：]?\s*([^\n]+)"],
            "incoterm": [r"Terms of delivery\s*[:：]?\s*([A-Z]{3})\b"],
            "currency": [r"Currency\s*[:：]?\s*([A-Z]{3})"],
        },
        ["number"],
        Items(r"^\s*\d+\s+\S", rf"\s(\d+\.\d{{2}})\s+{MONEY}\s+{MONEY}\s+(\d{{4}}-\d{{2}}-\d{{2}})\s*$", ["quantity", "unit", "net", "delivery"], r"^\s*(?:Net Value|Total Value)"),
    ),
    "sales_contract": Kind(
        ["合同", "Contract"],
        {
            "number": [r"Contract number\s*[:：]\s*(SO\d{7})", r"合同号\s*[:：]\s*(SO\d{7})"],
            "date": [r"Date\s+(\d{8})"],
            "total": [rf"本合同价款[^\n]*?{YEN}\s*{MONEY}", rf"(?s)Contract value.{{0,250}}?{YEN}\s*{MONEY}"],
            "party": [r"Party B\s*[:：]\s*([^\n]+)"],
            "delivery_weeks": [r"交货时间[^\n]*?(\d+)\s*周"],
            "warranty_years": [r"(?i)warranty period is\s*(\d)\s*years"],
            "payment_days": [r"(?i)within the (\d+) calendar days"],
            "net": [rf"(?i)Net Total Amount\s*{YEN}?\s*{MONEY}"],
            "drawing": [r"(\d-\d{3}-\d{3}-\d{4})"],
        },
        ["number"],
        Items(r"^\s*(?:\d+\s+)?[A-Z]{2}\.[\d.]+\d\s", rf"\s(\d+)\s*{YEN}\s*{MONEY}\s*{YEN}?\s*{MONEY}\s*$", ["quantity", "unit", "net"], r"(?i)^\s*Net Total Amount"),
    ),
    "purchase_contract": Kind(
        ["买卖合同"],
        {
            "number": [r"合同编号\s*[:：]\s*([A-Z]+\d+)"],
            "date": [r"签订时间\s*[:：]\s*(\d{4}年\d{2}月\d{2}日)"],
            "total": [rf"合计人民币金额[^\n]*?{YEN}\s*([\d,]+(?:\.\d{{2}})?)"],
            "delivery_days": [r"交货期限\s*[:：]\s*(\d+)\s*天"],
            "warranty_months": [r"提供(\d+)个月的保修"],
            "payment_days": [r"结算方式\s*[:：]\s*月结(\d+)天"],
            "model": [r"\b([A-Z]{2}[.][\w.-]+)"],
        },
    ),
    "invoice": Kind(
        ["电子发票|发票号码"],
        {
            "number": [r"\b(\d{20})\b"],
            "date": [r"(\d{4}年\d{2}月\d{2}日)"],
            "total": [rf"[（(]小写[）)]\s*{YEN}\s*{MONEY}", rf"(?m){YEN}\s*{MONEY}\s*$"],
            "contract": [r"合同编号\s*[:：]\s*([A-Z]+\d+)"],
            "model": [r"规格型号\s*\S*\s*([A-Z][\w.\-]+)"],
        },
    ),
}


def normal(text: Column) -> Column:
    """Full-width digits and points as plain ones, a full-width comma between digits too, and order numbers whose letter O was read as a zero."""
    # Most texts have nothing to change, and looking for it is much cheaper than rewriting them.
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.rlike("[０-９．，､]"), F.regexp_replace(F.translate(text, "０１２３４５６７８９．", "0123456789."), r"(?<=\d)[，､](?=\d{3}\b)", ",")).otherwise(text)
    return F.when(text.contains("S") & text.rlike("S[0０]"), F.regexp_replace(plain, r"\bS0(\d{7})\b", r"SO$1")).otherwise(plain)


def minor(text: Column) -> Column:
    """An amount in hundredths."""
    return (F.regexp_replace(text, ",", "").cast("decimal(20,2)") * 100).cast("long")


def _found(text: Column, patterns: Sequence[str]) -> Column:
    # Each pattern is sought once: ``nullif`` would work its first argument out twice.
    return F.coalesce(*[F.get(F.filter(F.array(F.trim(F.regexp_extract(text, p, 1))), lambda x: x != ""), 0) for p in patterns])


def _once(value: Column) -> Column:
    """A column that is worked out where it stands: filters stay above it, and no use of it repeats it."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _by_kind(kinds: Mapping[str, Kind], make: Callable[[Kind], Column | None]) -> Column:
    """What ``make`` says for the row's kind; null for other kinds."""
    out = F.when(F.lit(False), F.lit(None))
    for name, k in kinds.items():
        made = make(k)
        out = out if made is None else out.when(F.col("kind") == name, made)
    return out


def _date(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(digits) == 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)))


def read(documents: DataFrame, key: str, text: str, kinds: Mapping[str, Kind] = KINDS) -> DataFrame:
    """``key, kind, number, date, currency, net_minor, vat_minor, total_minor, fields, text`` of every document.

    ``kind`` is null, and so are the fields, where no kind fits: its words are
    missing or a field that it needs is.  An invoice with three amounts or more
    has its net value first, the tax next and the total last.  Null texts are
    empty; repeated rows stay.
    """
    rows = documents.select(F.col(key).alias("key"), _once(normal(F.col(text))).alias("text"))
    kind = F.lit(None).cast("string")
    for name, k in reversed(list(kinds.items())):
        fits = F.lit(True)
        for mark in k.marks:
            fits = fits & F.col("text").rlike(mark)
        for f in k.needs:
            fits = fits & _found(F.col("text"), k.fields[f]).isNotNull()
        kind = F.when(fits, F.lit(name)).otherwise(kind)
    # The kind is settled first, so that a text meets the patterns of its own kind only.
    rows = rows.withColumn("kind", _once(kind))
    value = lambda f: _by_kind(kinds, lambda k: _found(F.col("text"), k.fields[f]) if f in k.fields else None).cast("string")

    def more(k: Kind) -> Column:
        own = [f for f in k.fields if f not in ("number", "date", "currency", "net", "vat", "total")]
        return F.map_filter(F.create_map(*[x for f in own for x in (F.lit(f), _found(F.col("text"), k.fields[f]))]), lambda _, v: v.isNotNull()) if own else F.create_map().cast("map<string,string>")

    currency = F.when(F.col("kind").isNotNull(), F.coalesce(value("currency"), F.lit("CNY")))
    rows = rows.select("key", "text", "kind", value("number").alias("number"), value("date").alias("date"), currency.alias("currency"), *[value(a).alias(a) for a in ("net", "vat", "total")], _by_kind(kinds, more).alias("fields"))
    listed = F.regexp_extract_all("text", F.lit(rf"{YEN}\s*{MONEY}"), F.lit(1))
    rows = rows.withColumn("listed", F.when(F.col("kind") == "invoice", listed))
    by_place = F.when(F.size("listed") >= 3, F.col("listed"))
    names = F.regexp_extract_all("text", F.lit(r"名称\s*[:：]\s*([^\n]+?)(?=\s+名称|\n|$)"), F.lit(1))
    ids = F.regexp_extract_all("text", F.lit(r"\b([0-9A-Z]{18})\b"), F.lit(1))
    sides = F.create_map(
        F.lit("buyer"), F.trim(F.get(names, 0)), F.lit("seller"), F.trim(F.get(names, 1)),
        F.lit("buyer_tax_id"), F.when(F.size(ids) >= 2, F.get(ids, 0)), F.lit("seller_tax_id"), F.when(F.size(ids) >= 2, F.get(ids, 1)),
    )
    fields = F.when(F.col("kind") == "invoice", F.map_concat("fields", F.map_filter(sides, lambda _, v: v.isNotNull()))).otherwise(F.col("fields"))
    return rows.select(
        F.col("key").alias(key), "kind", "number", _date(F.col("date")).alias("date"), "currency",
        minor(F.coalesce(F.get(by_place, 0), "net")).alias("net_minor"), minor(F.coalesce(F.get(by_place, 1), "vat")).alias("vat_minor"),
        minor(F.coalesce(F.element_at(by_place, -1), "total")).alias("total_minor"), fields.alias("fields"), "text",
    )


def line_items(papers: DataFrame, key: str, kinds: Mapping[str, Kind] = KINDS) -> DataFrame:
    """``key, nth, text, quantity, unit_minor, net_minor, delivery, lines`` of the papers of :func:`read`, in their order.

    An item opens with a line that begins one and closes with the first line, the
    same or a later one, that ends in its figures; lines between are one
    description.  A line that begins an item while one is open only goes on with it
    if it has no figures of its own and the open one has none yet.  Lines behind the
    figures belong to no item.  Papers are told apart by ``key``, which is one row each.
    """
    return _items(papers, [key], kinds).where("nth is not null").drop("kind")


def _items(papers: DataFrame, keep: Sequence[str], kinds: Mapping[str, Kind]) -> DataFrame:
    """``keep``, ``kind`` and the columns of an item for each item; a paper without items is one row of nulls.

    A paper's lines stay in its row, so nothing is moved.
    """
    of = lambda make: _by_kind(kinds, lambda k: make(k.items) if k.items else None)
    keep = list(dict.fromkeys([*keep, "kind"]))
    rows = papers.select(*keep, of(lambda _: F.split("text", "\r?\n")).alias("lines__"))
    end = F.array_position(F.transform("lines__", lambda x: of(lambda i: x.rlike(i.ends))), F.lit(True)).cast("int")
    rows = rows.withColumn("lines__", _once(F.when(end > 0, F.slice("lines__", F.lit(1), end - 1)).otherwise(F.col("lines__"))))
    closes = F.array_compact(F.transform("lines__", lambda x, n: F.when(of(lambda i: x.rlike(i.figures)), n + 1)))
    rows = rows.withColumn("closes__", _once(closes))
    # A stretch is what stands behind the figures before, up to the next ones; the item begins at its first line that can begin one.
    before = lambda n: F.coalesce(F.get("closes__", n - 1), F.lit(0))
    stretches = F.transform("closes__", lambda at, n: F.slice("lines__", before(n) + 1, at - before(n)))
    begun = lambda s: F.array_position(F.transform(s, lambda x: of(lambda i: x.rlike(i.begins))), F.lit(True)).cast("int")
    opened = F.filter(F.transform(stretches, lambda s: F.struct(s.alias("lines"), begun(s).alias("at"))), lambda s: s["at"] > 0)
    rows = rows.withColumn("items__", _once(F.transform(opened, lambda s: F.slice(s["lines"], s["at"], F.size(s["lines"])))))
    rows = rows.select(*keep, F.posexplode_outer("items__").alias("at__", "item__"))
    rows = rows.select(*keep, (F.col("at__") + 1).alias("nth"), _once(F.array_join(F.transform("item__", lambda x: F.trim(x)), " ")).alias("all__"), F.when(F.col("item__").isNotNull(), F.size("item__")).cast("long").alias("lines"))
    figure = lambda n: of(lambda i: F.regexp_extract("all__", i.figures, list(i.names).index(n) + 1) if n in i.names else None).cast("string")
    return rows.select(
        *keep, "nth", F.trim(of(lambda i: F.regexp_replace("all__", i.figures, ""))).alias("text"),
        F.regexp_replace(figure("quantity"), ",", "").cast("decimal(18,4)").alias("quantity"), minor(figure("unit")).alias("unit_minor"), minor(figure("net")).alias("net_minor"), figure("delivery").alias("delivery"), "lines",
    )


def under_header(lines: DataFrame, keys: Sequence[str], at: str, line: str, labels: Sequence[str]) -> DataFrame:
    """``keys, at`` and a column for each label: the cells of the lines below the first line that has all ``labels`` in this order, cut where the labels begin.

    For tables set in a fixed width.  A line without anything under the first label
    goes on with the line before it: its cells are added to that line's.  An empty
    line ends the table.
    """
    from_start = Window.partitionBy(*keys).orderBy(at)
    in_order = "^.*?" + ".*?".join(f"({_quoted(x)})" for x in labels)
    place = lambda i: F.length(F.regexp_extract(line, "^(.*?" + ".*?".join(_quoted(x) for x in labels[: i + 1]) + ")", 1)) - len(labels[i]) + 1
    head = F.when(F.col(line).rlike(in_order), F.struct(F.col(at).alias("at"), F.array(*[place(i) for i in range(len(labels))]).alias("cuts")))
    rows = lines.withColumn("head__", F.first(head, ignorenulls=True).over(from_start)).where(F.col(at) > F.col("head__.at"))
    rows = rows.withColumn("over__", F.max(F.trim(line) == "").over(from_start)).where(~F.col("over__"))
    rows = rows.select(*keys, at, *[_cut(F.col(line), F.col("head__.cuts"), i, len(labels)).alias(x) for i, x in enumerate(labels)])
    nth = F.sum(F.when(F.col(f"`{labels[0]}`") != "", 1).otherwise(0)).over(from_start)
    joined = lambda x: F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct(at, F.col(f"`{x}`").alias("v")))), lambda s: s["v"]), lambda v: v != ""), " ").alias(x)
    return rows.withColumn("nth__", nth).where("nth__ > 0").groupBy(*keys, "nth__").agg(F.min(at).alias(at), *[joined(x) for x in labels]).drop("nth__")


def _quoted(text: str) -> str:
    return "".join(rf"\{c}" if not c.isalnum() and not c.isspace() else c for c in text)


def _cut(line: Column, cuts: Column, i: int, n: int) -> Column:
    start = F.lit(1) if i == 0 else F.get(cuts, i)
    size = F.get(cuts, i + 1) - start if i + 1 < n else F.length(line)
    return F.trim(F.substring(line, start, F.greatest(size, F.lit(0))))


def findings(papers: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """``key, finding``: sums that do not agree.

    The items' net values against the stated net (the total where no net is stated),
    each item's quantity times price against its net value, and net plus tax
    against the total; and papers of a kind with items that have none.
    """
    sums = items.groupBy(key).agg(*_sums())
    return _said(papers.select(key, "kind", "net_minor", "vat_minor", "total_minor").join(sums, key, "left"), key)


def own_findings(papers: DataFrame, key: str, kinds: Mapping[str, Kind] = KINDS) -> DataFrame:
    """The :func:`findings` of papers against the line items that they hold, in one pass: the papers are neither read twice nor joined with their items."""
    stated = ["kind", "net_minor", "vat_minor", "total_minor"]
    rows = papers.select(key, "text", "kind", *[F.col(c).alias(f"paper_{c}") for c in stated])
    of = _items(rows, [key, *[f"paper_{c}" for c in stated]], kinds).groupBy(key, *[f"paper_{c}" for c in stated]).agg(*_sums())
    return _said(of.select(key, *[F.col(f"paper_{c}").alias(c) for c in stated], "items_minor", "n_off"), key)


def _sums() -> list[Column]:
    return [F.sum("net_minor").alias("items_minor"), F.count_if(F.abs(F.col("quantity") * F.col("unit_minor") - F.col("net_minor")) > 1).alias("n_off")]


def _said(both: DataFrame, key: str) -> DataFrame:
    with_items = F.col("kind").isin(*[n for n, k in KINDS.items() if k.items])
    stated = F.coalesce("net_minor", "total_minor")
    checks = [
        (with_items & F.col("items_minor").isNull(), "no line items"),
        (F.col("items_minor") != stated, "items differ from the net value"),
        (F.col("n_off") > 0, "quantity times price differs"),
        (F.col("net_minor") + F.col("vat_minor") != F.col("total_minor"), "net and tax differ from the total"),
    ]
    said = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in checks]))
    return both.select(key, F.explode(said).alias("finding"))
