"""Likeness of names: the normalised indel ratio and what is built on it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word of Python's integers per row."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & where.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def indel_ratio(a: str | None, b: str | None) -> float | None:
    """100 times the share of letters that survive insertions and deletions."""
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    return 200.0 * _common(a, b) / total if total else 100.0


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The best ratio of the shorter text with a stretch of its length in the longer."""

    def best(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        x, y = sorted((x, y), key=len)
        return max((indel_ratio(x, y[k : k + len(x)]) for k in range(len(y) - len(x) + 1)), default=0.0) if x else 0.0

    return pd.Series([best(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.IntegerType())
def longest_run(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common run of letters."""

    def run(x: str | None, y: str | None) -> int:
        best, row = 0, [0] * (len(y or "") + 1)
        for c in x or "":
            row = [0] + [row[k] + 1 if c == d else 0 for k, d in enumerate(y or "")]
            best = max(best, *row)
        return best

    return pd.Series([run(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def near_contains(a: Column, b: Column) -> Column:
    """One text lies in the other and covers four fifths of it."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return (a.contains(b) | b.contains(a)) & (5 * short >= 4 * long)


def grams(text: Column, n: int | Column) -> Column:
    """Distinct runs of ``n`` characters; of a shorter text itself."""
    last = F.length(text) - n + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))
