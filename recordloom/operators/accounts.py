"""Account sheets: values that say the same in two spellings, the people of an account, columns known by their values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.customers import account_numbers
from ..functions.emails import addresses
from ..functions.text import CJK

_LETTERS = r"[^\p{L}\p{N}]"


def _key(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _LETTERS, "")


def _within(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def same_value(kind: str, a: Column, b: Column, alike: Column | None = None) -> Column:
    """Whether two values of a field say the same.

    ``kind``: ``place`` compares Chinese with Chinese and Latin with Latin, one in
    the other is the same, and a value in one script alone does not contradict the
    other; ``person`` takes swapped or missing words; ``order`` takes a year for a
    month of it; ``product`` ignores a leading ``roto``; ``name`` asks ``alike``, a test of the caller's
    such as a letter ratio; any other kind wants equal letters and digits.
    """
    ka, kb = _key(a), _key(b)
    filled = (ka != "") & (kb != "")
    if kind == "place":
        han = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), f"[^{CJK}]", "")
        latin = lambda c: F.regexp_replace(_key(c), f"[{CJK}]", "")
        apart = (han(a) != "") & (han(b) != "") & ~_within(han(a), han(b))
        other = ~apart & ((latin(a) == "") | (latin(b) == "") | _within(latin(a), latin(b)))
    elif kind == "person":
        words = lambda c: F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))))
        other = filled & (_within(ka, kb) | (words(a) == words(b)))
    elif kind == "order":
        other = filled & _within(ka, kb)
    elif kind == "product":
        other = F.regexp_replace(ka, "^roto", "") == F.regexp_replace(kb, "^roto", "")
    else:
        other = F.lit(False) if alike is None or kind != "name" else alike
    return F.coalesce((ka == kb) | other, F.lit(False))


def conflicts(rows: DataFrame, key: Sequence[str], order: Column, kinds: Mapping[str, str], source: str) -> DataFrame:
    """``key, source, field, value, kept``: known values that do not say the same as the first known one; ``kinds`` gives each field's kind."""
    spread = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in kinds])).alias("f")
    have = rows.select(*key, source, order.alias("order__"), spread).select(*key, source, "order__", "f.field", "f.value").where("value is not null")
    kept = have.groupBy(*key, "field").agg(F.min_by("value", "order__").alias("kept"))
    both = have.join(kept, [*key, "field"])
    same = F.lit(False)
    for field, kind in kinds.items():
        same = same | ((F.col("field") == field) & same_value(kind, F.col("value"), F.col("kept")))
    return both.where(~same).select(*key, source, "field", "value", "kept")


def people(rows: DataFrame, account: str, row: str, name: str, phone: str, mobile: str, email: str) -> DataFrame:
    """``account, person, name, phone, phones, emails, other``: one row for each name of an account, and one with a null name for cells of rows that name nobody.

    Values keep the order of the rows (``row``), mobile numbers before others of a
    row; each stands once.  ``phone`` is the cells as written.
    """
    empty = F.array().cast("array<string>")
    cell = lambda c: F.coalesce(F.col(c), F.lit(""))
    # A row that repeats an earlier one adds nothing, so each distinct row is read once, at its first place (the first is unknown where one is).
    written = list(dict.fromkeys([account, name, phone, mobile, email]))
    rows = rows.groupBy(*written).agg(F.when(F.count(row) == F.count("*"), F.min(row)).alias("row__"))
    # The fence keeps the optimizer from putting the reading back into every use.
    once = lambda c: F.when(F.monotonically_increasing_id() >= 0, account_numbers(cell(c)))
    rows = rows.withColumns({"mobile__": once(mobile), "phone__": once(phone)})
    from_mobile, from_phone = F.col("mobile__"), F.col("phone__")
    left = F.trim(F.regexp_replace(cell(email), "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", " "))
    mails = F.concat(addresses(cell(mobile)), addresses(cell(phone)), addresses(cell(email)))
    named = F.nullif(F.trim(cell(name)), F.lit(""))
    labelled = F.array(*[F.when(cell(c) != "", F.concat(F.lit(f"{label} "), cell(c))) for c, label in ((phone, "phone"), (mobile, "mobile"), (email, "e-mail"))])
    texts = F.concat(from_mobile["texts"], from_phone["texts"], F.when(left.rlike(r"[^ /,;、\n\t]"), F.array(F.regexp_replace(left, r"\s+", " "))).otherwise(empty))
    parts = rows.select(
        account, F.col("row__").alias("row"), named.alias("name"), F.lower(F.regexp_replace(named, r"\s", "")).alias("person"),
        F.array_compact(F.array(F.nullif(cell(phone), F.lit("")), F.nullif(cell(mobile), F.lit("")))).alias("written"),
        F.when(named.isNull(), empty).otherwise(F.concat(from_mobile["numbers"], from_phone["numbers"])).alias("phones"),
        F.when(named.isNull(), empty).otherwise(mails).alias("emails"),
        F.when(named.isNull(), F.array_compact(labelled)).otherwise(texts).alias("other"),
    )
    # An account's rows are few (its sheet lines); each list is what one person's row shows.
    listed = parts.groupBy(account, "person").agg(F.sort_array(F.collect_list(F.struct("row", "name", "written", "phones", "emails", "other"))).alias("r"))
    every = lambda field: F.array_distinct(F.flatten(F.transform("r", lambda x: x[field])))
    shown = F.when(F.col("person").isNotNull(), F.array_join(every("written"), " / "))
    return listed.select(account, "person", F.get("r", 0)["name"].alias("name"), shown.alias("phone"), every("phones").alias("phones"), every("emails").alias("emails"), every("other").alias("other"))


def columns_by_values(cells: DataFrame, sheet: Sequence[str], column: str, text: str, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """``sheet, field, column``: for each field the first column all of whose values are words of its domain."""
    said = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    tests = [F.bool_and(said.isin(*[w.lower() for w in words])).alias(field) for field, words in domains.items()]
    fits = cells.where(said != "").groupBy(*sheet, column).agg(*tests)
    spread = F.explode(F.array(*[F.when(F.col(f), F.lit(f)) for f in domains])).alias("field")
    return fits.select(*sheet, column, spread).where("field is not null").groupBy(*sheet, "field").agg(F.min(column).alias(column))
