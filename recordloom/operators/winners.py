"""Which record counts: newest, richest, most frequent; and what it supersedes.

Every function keeps the losers visible: as counts, as rows with the winner's
key, or as field conflicts.  Rankings are whole orders, so results don't depend
on how rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``rank`` (1: the winner) and ``members`` of each key; rows with a null in the key all win."""
    group = Window.partitionBy(*key)
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    rank = F.row_number().over(group.orderBy(*order))
    return rows.withColumn("rank", F.when(whole, rank).otherwise(1)).withColumn("members", F.when(whole, F.count("*").over(group)).otherwise(1))


def newest_wins(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, with ``superseded``: how many others it replaces."""
    return ranked(rows, key, order).where("rank = 1").withColumn("superseded", F.col("members") - 1).drop("rank", "members")


def superseded(rows: DataFrame, key: Sequence[str], order: Sequence[Column], winner: str) -> DataFrame:
    """The losers, with the winner's ``winner`` column as ``kept`` and a reason."""
    group = Window.partitionBy(*key).orderBy(*order)
    return ranked(rows.withColumn("kept", F.first(winner).over(group)), key, order).where("rank > 1").drop("rank", "members").withColumn("reason", F.lit("superseded"))


def first_known(rows: DataFrame, key: Sequence[str], order: Column, fields: Sequence[str]) -> DataFrame:
    """For each key and field the first value that is known, in ``order``; aggregated on the map side."""
    return rows.groupBy(*key).agg(*[F.min_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in fields], F.count("*").alias("members"))


def richness(fields: Sequence[str]) -> Column:
    """How many of the fields are known."""
    return sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))


def conflicts(rows: DataFrame, key: Sequence[str], order: Column, fields: Sequence[str], source: str) -> DataFrame:
    """``key, source, field, value, kept``: known values that differ from the winner's."""
    best = first_known(rows, key, order, fields).drop("members")
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("f")
    wide = lambda df, *more: df.select(*key, *more, long).select(*key, *more, "f.field", "f.value")
    have = wide(rows, source).where("value is not null")
    return have.join(wide(best).withColumnRenamed("value", "kept"), [*key, "field"]).where("value <> kept")


def most_frequent(rows: DataFrame, key: Sequence[str], value: str, seen: Column) -> DataFrame:
    """The most frequent value of each key; of equals the one seen first.  Two levels of counts, no window."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"), F.min(seen).alias("first_seen"))
    return counts.groupBy(*key).agg(F.min_by(F.struct(value, "n"), F.struct((-F.col("n")).alias("n"), "first_seen")).alias("best")).select(*key, F.col(f"best.{value}").alias(value), F.col("best.n").alias("n"))


def multiset_union(rows: DataFrame, group: Sequence[str], sheet: str, line: Sequence[str]) -> DataFrame:
    """Lines of all sheets of a group, each as often as the sheet that has it most often."""
    per_sheet = rows.groupBy(*group, sheet, *line).agg(F.count("*").alias("copies"))
    return per_sheet.groupBy(*group, *line).agg(F.max("copies").alias("copies"))


def numbered_repeats(rows: DataFrame, key: Sequence[str], order: Sequence[Column], name: Column) -> DataFrame:
    """``unique_id``: the name, with ``#n`` from the second row of a key on."""
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("nth", nth).withColumn("unique_id", F.when(F.col("nth") == 1, name).otherwise(F.concat(name, F.lit("#"), F.col("nth").cast("string"))))


def live_revision(rows: DataFrame, deal: Sequence[str], revision: str, order: Sequence[Column]) -> DataFrame:
    """The last revision of each deal; a number used twice makes deals of its own (``deal_part``, from 0)."""
    reused = F.row_number().over(Window.partitionBy(*deal, revision).orderBy(*order)) - 1
    parted = rows.withColumn("deal_part", reused)
    group = Window.partitionBy(*deal, "deal_part")
    return parted.withColumn("revisions", F.count("*").over(group)).withColumn("rank", F.row_number().over(group.orderBy(F.col(revision).desc()))).where("rank = 1").drop("rank")


def newest_snapshot(rows: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot, which replaces all older ones as a whole; the date comes from a one-row aggregate."""
    newest = rows.agg(F.max(snapshot).alias("newest"))
    return rows.join(F.broadcast(newest), F.col(snapshot) == F.col("newest")).drop("newest")
