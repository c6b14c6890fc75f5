"""What to write to a target: create, update or leave alone.

Plans only fill blanks; a value that differs is a reported conflict.  A plan
made against the state it has produced is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decide(wanted: DataFrame, held: DataFrame, key: str, stamp: str, fields: Sequence[str]) -> DataFrame:
    """``key, action``: ``create``, ``same``, ``newer`` (the target has a later stamp) or ``update``."""
    have = held.select(F.col(key), F.col(stamp).alias("held_stamp"), F.struct(*fields).alias("held"))
    rows = wanted.select(F.col(key), F.col(stamp).alias("stamp"), F.struct(*fields).alias("want")).join(have, key, "left")
    action = F.when(F.col("held").isNull(), "create").when(F.col("want").eqNullSafe(F.col("held")), "same").when(F.col("held_stamp") > F.col("stamp"), "newer").otherwise("update")
    return rows.select(key, action.alias("action"))


def zero_missing(held: DataFrame, snapshot: DataFrame, key: str, waiting: DataFrame | None = None) -> DataFrame:
    """Keys held but not in the newer snapshot, to be set to zero; none while anything waits for an answer."""
    gone = held.select(key).distinct().join(snapshot.select(key), key, "left_anti")
    if waiting is not None:
        gone = gone.join(F.broadcast(waiting.limit(1).agg(F.count("*").alias("open"))), F.col("open") == 0).drop("open")
    return gone.select(key, F.lit("zero").alias("action"))


def fill_blanks(held: DataFrame, wanted: DataFrame, key: str, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(patches, conflicts)``: values for blank fields, and known values that differ."""
    both = held.select(key, *[F.col(f).cast("string").alias(f"have_{f}") for f in fields]).join(wanted.select(key, *[F.col(f).cast("string").alias(f"want_{f}") for f in fields]), key)
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"have_{f}").alias("have"), F.col(f"want_{f}").alias("want")) for f in fields])).alias("f")
    rows = both.select(key, long).select(key, "f.*").where("want is not null")
    return rows.where("have is null").select(key, "field", "want"), rows.where("have is not null and have <> want")


def extended(have: Column, new: Column) -> Column:
    """What is held, in its order, and behind it what is new."""
    return F.concat(have, F.array_except(new, have))


def appended_revisions(revisions: DataFrame, held: DataFrame, deal: str, order: str) -> DataFrame:
    """Revisions beyond the number that the target holds of each deal."""
    from pyspark.sql import Window

    placed = revisions.withColumn("nth", F.row_number().over(Window.partitionBy(deal).orderBy(order)))
    counts = held.groupBy(deal).agg(F.count("*").alias("held"))
    return placed.join(counts, deal, "left").where(F.col("nth") > F.coalesce("held", F.lit(0))).drop("held")


def reconcile(expected: DataFrame, actual: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``key, field, expected, actual, status`` with status ``VERIFIED``, ``CHANGED``, ``MISSING``, ``EXTRA`` or ``DUPLICATE``.

    Keys are counted before the join, so a key that repeats on the actual side
    is one row and not a product.
    """
    side = lambda df, name: df.groupBy(key).agg(F.count("*").alias(f"n_{name}"), *[F.min(F.col(f).cast("string")).alias(f"{name}_{f}") for f in fields])
    both = side(expected, "e").join(side(actual, "a"), key, "full_outer")
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"e_{f}").alias("expected"), F.col(f"a_{f}").alias("actual")) for f in fields])).alias("f")
    status = F.when(F.col("n_a").isNull(), "MISSING").when(F.col("n_e").isNull(), "EXTRA").when(F.col("n_a") > F.col("n_e"), "DUPLICATE").when(F.col("f.expected").eqNullSafe(F.col("f.actual")), "VERIFIED").otherwise("CHANGED")
    return both.select(key, "n_e", "n_a", long).select(key, "f.field", "f.expected", "f.actual", status.alias("status"))


def cross_tab(findings: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """``field`` by status, with closed columns so that the plan needs no extra pass."""
    return findings.groupBy("field").agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in statuses])


def consensus(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``key, state, differing``: two readings of the same records ``agree``, are ``disputed`` in some fields, or stand ``single``."""
    left = a.select(key, F.struct(*fields).alias("a"))
    right = b.select(key, F.struct(*fields).alias("b"))
    differing = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), f) for f in fields])), ",")
    state = F.when(F.col("a").isNull() | F.col("b").isNull(), "single").when(differing == "", "agree").otherwise("disputed")
    return left.join(right, key, "full_outer").select(key, state.alias("state"), F.when(state == "disputed", differing).alias("differing"))


def latest_answers(decisions: DataFrame, a: str, b: str, stamp: str, answer: str) -> DataFrame:
    """The last answer for each unordered pair of names."""
    pair = F.array_sort(F.array(a, b))
    return decisions.groupBy(pair[0].alias("a"), pair[1].alias("b")).agg(F.max_by(answer, stamp).alias(answer))


def behind_cutoff(rows: DataFrame, due: Column, day: str) -> DataFrame:
    """``rows`` with ``closed``: what is due before the Monday of the batch's newest week is history.  One value, the newest day, comes to the driver."""
    newest = rows.agg(F.date_format(F.trunc(F.max(day), "week"), "yyyy-MM-dd")).first()[0]
    return rows.withColumn("closed", F.coalesce(due < F.lit(newest).cast("date"), F.lit(False)))
