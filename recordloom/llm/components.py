"""Connected components by contraction, on stored tables.

Each round every node hooks to its least neighbour, chains of hooks are halved
until they end, and edges are rewritten between what is left.  Counts are
pre-aggregated before they are shuffled, and joins have plain shuffles on both
sides, so that Spark can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node with a smaller node in its component; ``root`` is the smallest.

    Nodes are non-null longs.  Loops and repeated edges do no harm; no edges give
    an empty table.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = stored(edges, "edges")
    found: DataFrame | None = None
    while not edges.isEmpty():
        hooks = stored(edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"), "hooks")
        while True:
            onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stored(hooks.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "hooks")
            dropped(hooks)
            hooks, moved = jumped.select("node", "root"), not jumped.where("moved").isEmpty()
            if not moved:
                break
        of = lambda name: hooks.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        ends = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y"))
        less = stored(ends.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
        if found is None:
            found = hooks
        else:
            before = found
            kept = found.withColumnRenamed("root", "mid").join(hooks.select(F.col("node").alias("mid"), "root"), "mid", "left").select("node", F.coalesce("root", "mid").alias("root"))
            found = stored(kept.unionByName(hooks.join(found.select("node"), "node", "left_anti")), "roots")
            dropped(before)
            dropped(hooks)
        dropped(edges)
        edges = less
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
