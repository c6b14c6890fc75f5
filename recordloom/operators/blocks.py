"""Rows that belong to the row above: blocks, fill-down, ordinals, intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_numbers(rows: DataFrame, sheet: Sequence[str], order: Sequence[Column], starts: Column) -> DataFrame:
    """``block``: how many starts there are up to each row; 0 before the first."""
    run = Window.partitionBy(*sheet).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("block", F.sum(F.when(starts, 1).otherwise(0)).over(run))


def block_spans(rows: DataFrame, sheet: Sequence[str], order: Sequence[Column], starts: Column, position: str) -> DataFrame:
    """``sheet, block, first, last, items``: from each start to the row before the next."""
    numbered = block_numbers(rows, sheet, order, starts).where("block > 0")
    return numbered.groupBy(*sheet, "block").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("items"))


def fill_down(rows: DataFrame, sheet: Sequence[str], order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """The last known value carried down."""
    run = Window.partitionBy(*sheet).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(run))


def ordinals(rows: DataFrame, key: Sequence[str | Column], order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """Place of each row within its key, from 0."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def attach_to_intervals(points: DataFrame, spans: DataFrame, on: Sequence[str], position: str, first: str = "first", last: str = "last") -> DataFrame:
    """Points with the span of their sheet that holds them: a join on the sheet with the interval as its residual."""
    return points.join(spans, list(on)).where(F.col(position).between(F.col(first), F.col(last)))


def slots(day: Column, ordinal: Column, start_hour: int = 9, step_hours: int = 2) -> Column:
    """A time on a day: ``start_hour`` for the first, ``step_hours`` later for each that follows; may run into the next day."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (start_hour + step_hours * ordinal).cast("int"))


def ordered_list(rows: DataFrame, key: Sequence[str], order: Column, value: str, name: str) -> DataFrame:
    """Values of a key in ``order``; ``collect_list`` alone promises no order."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(value).alias("v"))))
    return rows.groupBy(*key).agg(F.transform(pairs, lambda p: p["v"]).alias(name))
