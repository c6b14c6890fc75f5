"""Filter interaction audit: what five filters remove in each of their 120 orders.

A document's failures are five bits.  Four of them follow from the text and are
native expressions of one scan; the fifth (a copy of a document with a smaller
id) comes from grouping by text.  Only counts of masks, at most 32 for each
part, go on: every order and step is worked out from those cells.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
_STEPS = "array<struct<filter_order string, step int, bit int, before int>>"


def failure_mask(text: Column) -> Column:
    """The bits of filters A to D of a text without nulls: under 200 words, under half of the words distinct, over 2 % capitals, a symbol.

    All filters are judged on whole texts; a text without words fails A only.
    """
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    # One condition at a time over one set of counts: the array keeps them from being worked out again for each.
    of_words = lambda c: F.when(c["words"] < 200, 1).otherwise(0) + F.when(100 * c["distinct"].cast("long") < 50 * c["words"].cast("long"), 2).otherwise(0)
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return (
        F.transform(F.array(counts), of_words)[0]
        + F.when(100 * capitals > 2 * F.length(text), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
    )


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part and mask, those labelled ``quality = 1`` and those labelled ``toxic = 1``.

    Texts count as one where their SHA-256 agrees, so texts are read once and
    never shuffled.  Copies of a text share the first four bits; they are counted
    before they are dealt out, so a text in a third of all rows is one row a task.
    A null text is empty, a null source the part ``''``.  Rows with the smallest
    id of their text are no copies, however often they are repeated; a null id is
    neither a copy nor an original.  Of several labels of a document one that
    says 1 is enough; labels of unknown documents do nothing.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), failure_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("same"))
    # Rows without an id meet no label; their text deals them out.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.col("same")).otherwise(F.lit(b"")))
    is_one = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    said = said.select("doc_id", F.lit(b"").alias("spread"), F.col("quality").alias("good"), "toxic")
    by_id = (
        rows.join(said, ["doc_id", "spread"], "left")
        .groupBy("doc_id", "spread", "same", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .agg(F.count("*").alias("n"))
    )
    known = F.col("doc_id").isNotNull()
    by_text = by_id.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_without_id"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"),
    )
    least = F.min("least.doc_id").over(Window.partitionBy("same"))
    first = F.col("n_without_id") + F.when(F.col("least.doc_id") == least, F.col("least.n")).otherwise(0)
    both = by_text.withColumn("first", first).select(
        "part", "good", "toxic",
        F.inline(F.array(F.struct(F.col("mask"), F.col("first").alias("n")), F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - F.col("first")).alias("n")))),
    )
    total = lambda name: F.sum(F.col("n") * F.col(name)).alias(name)
    return both.where("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good"), total("toxic"))


def orders() -> list[dict]:
    """All orders of the filters, step by step: the filter's bit and the bits of those before it."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": order, "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step; see :func:`cells` for odd rows.  No documents, no rows.

    ``shapley`` is what the step's filter removes, summed over all orders: a
    document that fails k filters is removed by each of them in 120 / k orders.
    """
    table = F.collect_list(F.struct("mask", "n", "good", "toxic"))
    parts = cells(docs, labels).groupBy("part").agg(table.alias("cells"))
    rows = parts.select("part", "cells", F.inline(F.from_json(F.lit(json.dumps(orders())), _STEPS)))
    bit, before = F.col("bit"), F.col("before")

    def total(where, value=lambda c: c["n"]) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(where(c["mask"]), value(c)).otherwise(0))

    fails = lambda m: m.bitwiseAND(bit) != 0
    alive = lambda m: m.bitwiseAND(before) == 0
    here = lambda m: fails(m) & alive(m)
    share = lambda c: F.call_function("div", c["n"] * len(list(permutations(FILTERS))), F.bit_count(c["mask"]))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: alive(m) & ~fails(m)).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: fails(m) & ~alive(m)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"),
        total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )
