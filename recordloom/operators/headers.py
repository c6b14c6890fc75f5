"""Sheets of cells to typed rows: headers found by label, merges, sections.

Cells are long rows ``(file, sheet, row, col, text, merge_row, merge_col)``; a
cell of a merged area names its top left cell.  Labels and synonyms are data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import label_key, sensitive

SHEET = ("file", "sheet")


def synonyms(spark: SparkSession, table: Mapping[str, Sequence[str]]) -> DataFrame:
    """``field, label, exact, priority``; a label that begins with ``=`` must be equal, any other may be a prefix."""
    rows = [(f, w.lstrip("="), w.startswith("="), k) for k, (f, w) in enumerate((f, w) for f, words in table.items() for w in words)]
    return spark.createDataFrame(rows, "field string, label string, exact boolean, priority int")


def resolved(cells: DataFrame) -> DataFrame:
    """Cells with the text of the merged area they lie in."""
    tops = cells.select(*SHEET, F.col("row").alias("merge_row"), F.col("col").alias("merge_col"), F.col("text").alias("top_text"))
    joined = cells.join(tops, [*SHEET, "merge_row", "merge_col"], "left")
    return joined.select(*SHEET, "row", "col", F.coalesce("text", "top_text").alias("text"), (F.col("merge_row").isNotNull() & ((F.col("merge_row") != F.col("row")) | (F.col("merge_col") != F.col("col")))).alias("continued"))


def header_fields(cells: DataFrame, words: DataFrame, most_rows: int = 30) -> DataFrame:
    """``file, sheet, row, col, field``: labels of the first rows and what they stand for; the first column of a field counts."""
    labels = cells.where((F.col("row") <= most_rows) & F.col("text").isNotNull()).where(~sensitive(F.col("text"))).withColumn("key", label_key(F.col("text")))
    # Labels meet on equal text: a cell's whole label, or one of its beginnings no longer than the longest synonym.
    longest = words.agg(F.max(F.length("label"))).first()[0] or 0
    ends = F.sequence(F.lit(1), F.least(F.length("key"), F.lit(longest)))
    starts = F.when(F.length("key") > 0, F.transform(ends, lambda n: F.substring("key", F.lit(1), n))).otherwise(F.array(F.lit("")))
    spread = labels.withColumn("label", F.explode(starts))
    named = spread.join(words, "label").where((F.col("key") == F.col("label")) | ~F.col("exact")).groupBy(*SHEET, "row", "col").agg(F.min_by("field", "priority").alias("field"))
    return named.groupBy(*SHEET, "row", "field").agg(F.min("col").alias("col"))


def find_headers(cells: DataFrame, words: DataFrame, least: int, required: Sequence[str], first_only: bool = True, most_rows: int = 30) -> DataFrame:
    """``file, sheet, header_row, until, field, col``: rows with enough fields and all required ones; a header holds until the next."""
    fields = header_fields(cells, words, most_rows)
    rows = fields.groupBy(*SHEET, "row").agg(F.count("*").alias("n"), F.collect_set("field").alias("have"))
    rows = rows.where((F.col("n") >= least) & (F.size(F.array_except(F.array(*[F.lit(r) for r in required]), "have")) == 0))
    order = Window.partitionBy(*SHEET).orderBy("row")
    rows = rows.withColumn("until", F.lead("row").over(order)).withColumn("nth", F.row_number().over(order))
    if first_only:
        rows = rows.where("nth = 1").withColumn("until", F.lit(None).cast("int"))
    return rows.select(*SHEET, "row", "until").join(fields, [*SHEET, "row"]).select(*SHEET, F.col("row").alias("header_row"), "until", "field", "col")


def pivoted(cells: DataFrame, headers: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per sheet row below a header, with a column for each of the closed list of fields."""
    inside = cells.join(headers, [*SHEET, "col"]).where((F.col("row") > F.col("header_row")) & (F.col("until").isNull() | (F.col("row") < F.col("until"))))
    out = inside.groupBy(*SHEET, "header_row", "row").agg(*[F.max(F.when(F.col("field") == f, F.col("text"))).alias(f) for f in fields])
    return out.where(F.coalesce(*[F.col(f) for f in fields]).isNotNull())


def extras(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """``file, sheet, row, extra``: what stands under labels that stand for no field; a repeated label gets a number."""
    top = headers.select(*SHEET, "header_row").distinct()
    labels = cells.join(top, list(SHEET)).where(F.col("row") == F.col("header_row")).where(F.col("text").isNotNull() & ~sensitive(F.col("text")))
    labels = labels.join(headers.select(*SHEET, "col"), [*SHEET, "col"], "left_anti")
    nth = F.row_number().over(Window.partitionBy(*SHEET, "text").orderBy("col"))
    labels = labels.withColumn("nth", nth).select(*SHEET, "header_row", "col", F.when(F.col("nth") > 1, F.concat("text", F.lit(" ("), "nth", F.lit(")"))).otherwise(F.col("text")).alias("label"))
    below = cells.where("text is not null").join(labels, [*SHEET, "col"]).where("row > header_row")
    return below.groupBy(*SHEET, "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "text")))).alias("extra"))


def beside(cells: DataFrame, label: str) -> DataFrame:
    """``file, sheet, value``: the first text to the right of a label."""
    at = cells.where(label_key(F.col("text")) == label).groupBy(*SHEET).agg(F.min(F.struct("row", "col")).alias("at"))
    right = cells.join(at, list(SHEET)).where("row = at.row and col > at.col and text is not null")
    return right.groupBy(*SHEET).agg(F.min_by("text", "col").alias("value"))


def skip_reasons(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``reason`` for rows that are no records: blank, a total, a repeated header, or without a key; null for records."""
    known = [F.col(f).isNotNull() for f in fields]
    blank = ~F.coalesce(*[F.when(k, True) for k in known], F.lit(False))
    total = F.coalesce(*[F.when(F.lower(F.col(f)).rlike(r"^(?:sub)?total\b|^合计|^总计|^小计|^summe\b"), True) for f in fields], F.lit(False))
    return rows.withColumn("reason", F.when(blank, "blank row").when(total, "total row").when(F.col(key) == F.lit(key), "repeated header").when(F.col(key).isNull(), "no key"))
