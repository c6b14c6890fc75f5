"""Joins of records with what is already known."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


def first_alias(rows: DataFrame, key: str, aliases: str, names: DataFrame, name: str, target: str) -> DataFrame:
    """``key, target, alias_pos``: the target of the first alias that is known."""
    spelled = rows.select(key, F.posexplode(aliases).alias("alias_pos", name))
    return spelled.join(names.select(name, target), name).groupBy(key).agg(F.min(F.struct("alias_pos", target)).alias("m")).select(key, f"m.{target}", "m.alias_pos")


def unique_match(names: DataFrame, name: str, targets: DataFrame, target: str) -> DataFrame:
    """``name, target, state``: the target if there is exactly one, else ``ambiguous`` or ``none``."""
    counts = targets.groupBy(name).agg(F.count_distinct(target).alias("n"), F.min(target).alias("one"))
    out = names.select(name).distinct().join(counts, name, "left")
    state = F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "unique").otherwise("ambiguous")
    return out.select(name, F.when(F.col("n") == 1, F.col("one")).alias(target), state.alias("state"))


def missing(wanted: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    return wanted.join(present.select(*on), list(on), "left_anti")


def used(dimension: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    return dimension.join(facts.select(*on), list(on), "left_semi")


def nearest_of(candidates: Column, ref: Column) -> Column:
    """``day, off``: the candidate nearest to ``ref``; the first of equals."""
    best = F.array_min(F.transform(F.array_compact(candidates), lambda c, k: F.struct(F.abs(F.date_diff(c, ref)).alias("off"), k.alias("k"), c.alias("day"))))
    return F.struct(best["day"].alias("day"), best["off"].alias("off"))


def roots(messages: DataFrame, child: str, parent: str) -> DataFrame:
    """``child, root, depth`` of every message by pointer jumping; a parent that is not among the messages is the end.

    A cycle has no root: its members, and what leads into it, are cut loose and get themselves.
    Every round ends the messages up to twice as far from their root as the last, so
    a round that ends none has only cycles left.
    """
    known = messages.select(F.col(child).alias("known__")).distinct()
    up = messages.join(known, F.col(parent) == F.col("known__"), "left").select(F.col(child).alias("child"), F.when(F.col("known__") != F.col(child), F.col("known__")).alias("up"))
    now = stored(up.select("child", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.coalesce("up", "child").alias("root")), "roots")
    before = None
    while (still := now.where("up is not null").count()) not in (0, before):
        before = still
        onward = now.select(F.col("child").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("root").alias("end"))
        # Only messages that have not reached their end jump on.
        moved = now.where("up is not null").join(onward, "up").select("child", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("end").alias("root"))
        now = stored(now.where("up is null").unionByName(moved), "roots")
    loop = F.col("up").isNotNull()
    return now.select(F.col("child").alias(child), F.when(loop, F.col("child")).otherwise(F.col("root")).alias("root"), F.when(loop, 0).otherwise(F.col("depth")).cast("long").alias("depth"))


def greedy_overlap(left: DataFrame, right: DataFrame, group: str, left_id: str, right_id: str, shared: str) -> DataFrame:
    """``group, right_id, left_id, overlap``: right items in order of their id take the left item that shares most with them, each once.

    Overlaps are counted by a join; only the choice, which is sequential, runs
    group by group on the counted pairs.
    """
    l, r = left.select(group, F.col(left_id).alias("l"), F.explode(shared).alias("s")).distinct(), right.select(group, F.col(right_id).alias("r"), F.explode(shared).alias("s")).distinct()
    pairs = l.join(r, [group, "s"]).groupBy(group, "r", "l").agg(F.count("*").alias("overlap"))

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for _, rows in part.sort_values(["r", "overlap", "l"], ascending=[True, False, True]).groupby("r", sort=True):
            free = rows[~rows["l"].isin(taken)]
            if len(free):
                taken.add(free.iloc[0]["l"])
                out.append(free.iloc[0])
        return pd.DataFrame(out, columns=part.columns)

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    chosen = pairs.groupBy(group).applyInPandas(choose, ", ".join(f"`{k}` {v}" for k, v in kinds.items()))
    return chosen.select(group, F.col("r").alias(right_id), F.col("l").alias(left_id), "overlap")


def reset_running(sizes: DataFrame, group: str, order: str, size: str, most: int) -> DataFrame:
    """``group, order, part``: consecutive items of a group share a part until ``most`` is passed.

    A part begins where the last one ended, so a group is read in order; tasks hold
    three numbers for it, however many items it has.
    """
    kinds = dict(sizes.dtypes)
    rows = sizes.select(group, order, F.col(size).cast("long").alias("n")).repartition(group).sortWithinPartitions(group, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, filled, started = None, 0, 0, False
        for batch in batches:
            parts = []
            for key, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not started or key != now:
                    now, part, filled, started = key, 0, 0, True
                over = filled > 0 and filled + (n or 0) > most
                part, filled = part + over, (n or 0) + (0 if over else filled)
                parts.append(part)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.int64())], [group, order, "part"])

    return rows.mapInArrow(run, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, part long")


def by_any_of(rows: DataFrame, key: str, listed: str, known: DataFrame, name: str, values: str) -> DataFrame:
    """``key, found``: the distinct ``values`` of all members of the array ``listed`` that ``known`` has under ``name``, sorted; keys without any have an empty array."""
    spread = rows.select(key, F.explode(listed).alias(name)).distinct()
    got = spread.join(known.select(name, F.explode(values).alias("v")).distinct(), name).groupBy(key).agg(F.array_sort(F.collect_set("v")).alias("found"))
    return rows.select(key).distinct().join(got, key, "left").select(key, F.coalesce("found", F.array().cast(got.schema["found"].dataType)).alias("found"))


def with_sums(rows: DataFrame, key: str, facts: DataFrame, unit: str, amount: str) -> DataFrame:
    """``rows`` with ``sums``: unit to exact sum of ``facts`` of the same key, currencies never added together; empty without facts."""
    per = facts.where(F.col(amount).isNotNull()).groupBy(key, unit).agg(F.sum(F.col(amount).cast("decimal(18,2)")).alias("total"))
    sums = per.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(unit, "total")))).alias("sums"))
    return rows.join(sums, key, "left").withColumn("sums", F.coalesce("sums", F.create_map().cast(sums.schema["sums"].dataType)))


def covered_by(part: Column, whole: Column) -> Column:
    """Every member of an array is in the other."""
    return F.size(F.array_except(part, whole)) == 0


def one_at_most(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value, with that value."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n"), F.min(value).alias(value)).where("n = 1").drop("n")


def top_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("place") <= most)
