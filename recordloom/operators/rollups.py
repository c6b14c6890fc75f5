"""Lines to documents, snapshots to balances, visits to profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_sum(value: Column) -> Column:
    """Exact sum of amounts, nulls counting as nothing."""
    return F.sum(F.coalesce(value.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")))


def documents(lines: DataFrame, key: str, amount: str, quantity: str) -> DataFrame:
    """One row per document: ``lines``, summed ``quantity`` and ``amount``."""
    return lines.groupBy(key).agg(F.count("*").alias("lines"), money_sum(F.col(quantity)).alias("quantity"), money_sum(F.col(amount)).alias("amount"))


def document_issues(lines: DataFrame, key: str, amount: str, party: str, share: float = 0.0, slack: float = 0.05, least: int = 3) -> DataFrame:
    """``lines, several_parties, missing_amount, hidden_total`` for each document.

    A hidden total is a line that equals the sum of the others, within ``slack``
    or a ``share`` of that sum.  The largest line alone can be one, so one pass
    of aggregates is enough.
    """
    m = F.col(amount).cast("decimal(18,2)")
    out = lines.groupBy(key).agg(
        F.count("*").alias("lines"), F.count(m).alias("amounts"), F.count_distinct(party).alias("parties"), F.sum(m).alias("total"), F.max(m).alias("largest"),
    )
    rest = F.col("total") - F.col("largest")
    hidden = (F.col("amounts") >= least) & (F.abs(F.col("largest") - rest) <= F.greatest(F.lit(slack).cast("decimal(18,4)"), rest * F.lit(share).cast("decimal(4,2)")))
    return out.select(key, "lines", (F.col("parties") > 1).alias("several_parties"), (F.col("amounts") < F.col("lines")).alias("missing_amount"), F.coalesce(hidden, F.lit(False)).alias("hidden_total"))


def total_or_stated(lines: DataFrame, key: Sequence[str], amount: Column, stated: Column) -> DataFrame:
    """The sum of the lines where each has an amount, else the one total that the lines repeat, else null."""
    m, s = amount.cast("decimal(18,2)"), stated.cast("decimal(18,2)")
    # Least and largest are equal where there is one total: unlike a distinct count, they are two values a key in every step.
    total = F.when(F.count(m) == F.count("*"), F.sum(m)).when(F.min(s) == F.max(s), F.max(s))
    return lines.groupBy(*key).agg(total.cast("decimal(18,2)").alias("total"))


def total_of_lines_or_stated(documents: DataFrame, lines: DataFrame, key: str, amount: Column, stated: Column) -> DataFrame:
    """:func:`total_or_stated` of documents joined with their lines on ``key``, which is never built: both are summed by their key in one aggregate.

    Several documents of one key count each line as often, as the join would; keys of one side only have no row.
    """
    m, s = amount.cast("decimal(18,2)"), stated.cast("decimal(18,2)")
    row = lambda df, line, m, s: df.where(F.col(key).isNotNull()).select(key, F.lit(line).alias("line__"), m.alias("m__"), s.alias("s__"))
    no = F.lit(None).cast("decimal(18,2)")
    of = row(lines, 1, m, no).unionByName(row(documents, 0, no, s)).groupBy(key).agg(
        F.sum("line__").alias("lines__"), F.count("*").alias("rows__"), F.count("m__").alias("amounts__"), F.sum("m__").alias("sum__"), F.min("s__").alias("least__"), F.max("s__").alias("most__"),
    )
    times = F.col("rows__") - F.col("lines__")
    total = F.when(F.col("amounts__") == F.col("lines__"), F.col("sum__") * times).when(F.col("least__") == F.col("most__"), F.col("most__"))
    return of.where((F.col("lines__") > 0) & (times > 0)).select(key, total.cast("decimal(18,2)").alias("total"))


def receivables(invoices: DataFrame, party: str, number: str, due: str, amount: str, as_of: Column) -> DataFrame:
    """Open and overdue sums and counts of each party; no due date is open but never overdue; zero amounts are no invoices."""
    m = F.col(amount).cast("decimal(18,2)")
    rows = invoices.where(m.isNotNull() & (m != 0))
    late = F.coalesce(F.col(due) < as_of, F.lit(False))
    return rows.groupBy(party).agg(
        F.count("*").alias("n_open"), F.sum(m).alias("open"), F.count_if(late).alias("n_overdue"), money_sum(F.when(late, m)).alias("overdue"),
        F.min(due).alias("oldest_due"), (F.count(number) > F.count_distinct(number)).alias("number_twice"),
    )


def profile(visits: DataFrame, key: str, day: str, order: Column, latest: Sequence[str], distinct: str) -> DataFrame:
    """First and last day, count, latest known values and the distinct values of a column."""
    return visits.groupBy(key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("visits"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"latest_{c}") for c in latest],
        F.array_join(F.array_sort(F.collect_set(distinct)), ",").alias(f"all_{distinct}"),
    )


def decision(flags: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The reason of the first condition that holds."""
    out = None
    for condition, reason in flags:
        out = F.when(condition, F.lit(reason)) if out is None else out.when(condition, F.lit(reason))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def dominant(rows: DataFrame, key: Sequence[str], value: str, factor: int = 3) -> DataFrame:
    """``value`` where one value is alone or ``factor`` times as frequent as the next, else a conflict.

    Two values are enough to decide, so each key keeps its two best counts only.
    """
    counts = rows.groupBy(*key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(*key).agg(F.max(F.struct("n", value)).alias("first"), F.sum("n").alias("total"), F.count("*").alias("values"))
    second = counts.join(best.select(*key, F.col(f"first.{value}").alias("top")), list(key)).where(F.col(value) != F.col("top")).groupBy(*key).agg(F.max("n").alias("second"))
    out = best.join(second, list(key), "left").withColumn("second", F.coalesce("second", F.lit(0)))
    wins = F.col("first.n") >= factor * F.col("second")
    return out.select(*key, F.when(wins, F.col(f"first.{value}")).alias(value), F.when(wins, "dominant").otherwise("conflict").alias("verdict"), F.col("first.n").alias("n_first"), F.col("second").alias("n_second"))


def mutual_best(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs that are each other's most frequent partner; equal counts go to the lesser name."""
    counts = rows.groupBy(a, b).agg(F.count("*").alias("n"))
    for_a = counts.groupBy(a).agg(F.min_by(F.struct(b, "n"), F.struct((-F.col("n")).alias("n"), b)).alias("x")).select(a, f"x.{b}", "x.n")
    for_b = counts.groupBy(b).agg(F.min_by(F.struct(a, "n"), F.struct((-F.col("n")).alias("n"), a)).alias("x")).select(f"x.{a}", b)
    return for_a.join(for_b, [a, b])
