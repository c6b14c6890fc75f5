"""Saved answers of a paged interface: pages put in order by their cursors, and company records out of them.

Each page names the next one.  The chain is followed by pointer jumping from its
first page, so a list of a million pages takes twenty rounds; what breaks the chain
(a page that is missing, named twice, never named, or leads back) is a finding, and
records are only taken from pages that the chain reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored


def chained(pages: DataFrame, cursor: str, following: str, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(order, findings)`` of pages (``cursor``: null for the first; ``following``: null for the last).

    ``order``: ``source, cursor, nth`` of the pages that the first one leads to, from
    0.  ``findings``: ``source, cursor, finding`` with ``repeated`` (a cursor on
    several pages; one of them counts), ``missing`` (named, not there),
    ``unreached`` (there, but the first page does not lead to it), ``loop`` (a page of the
    chain leads back to one before it) and ``no first page``.  Chains of several
    ``source`` values are told apart.
    """
    src = F.col(source) if source else F.lit("")
    rows = pages.select(src.alias("source"), F.coalesce(cursor, F.lit("")).alias("cursor"), F.col(following).alias("following"))
    one = stored(rows.groupBy("source", "cursor").agg(F.min("following").alias("following"), F.count("*").alias("n")), "pages")
    # Distance from the first page, doubling: after k rounds every page knows the one 2**k pages on.
    there = one.select("source", F.col("cursor").alias("following"), F.lit(True).alias("there"))
    known = one.join(there, ["source", "following"], "left")
    hop = stored(known.select("source", "cursor", F.when(F.col("there"), F.col("following")).alias("next")), "hops")
    total = one.count()
    reached = stored(one.where("cursor = ''").select("source", "cursor", F.lit(0).cast("long").alias("nth")), "reached")
    size, before = 1, 0
    while size < 2 * total and (now := reached.count()) != before:
        before = now
        onward = reached.join(hop.where("next is not null"), ["source", "cursor"]).select("source", F.col("next").alias("cursor"), (F.col("nth") + size).alias("nth"))
        reached = stored(reached.unionByName(onward).groupBy("source", "cursor").agg(F.min("nth").alias("nth")), "reached")
        twice = hop.select("source", F.col("cursor").alias("next"), F.col("next").alias("far"))
        hop = stored(hop.join(twice, ["source", "next"], "left").select("source", "cursor", F.col("far").alias("next")), "hops")
        size *= 2
    say = lambda df, what: df.select("source", "cursor", F.lit(what).alias("finding"))
    along = known.join(reached, ["source", "cursor"])
    back = along.join(reached.select("source", F.col("cursor").alias("following"), F.col("nth").alias("later")), ["source", "following"]).where("later <= nth")
    first = one.where("cursor = ''").select("source")
    findings = (
        say(one.where("n > 1"), "repeated")
        .unionByName(say(along.where("following is not null and there is null").withColumn("cursor", F.col("following")), "missing"))
        .unionByName(say(one.join(reached, ["source", "cursor"], "left_anti"), "unreached"))
        .unionByName(say(back, "loop"))
        .unionByName(say(one.select("source").distinct().join(first, "source", "left_anti").withColumn("cursor", F.lit(None).cast("string")), "no first page"))
    )
    return reached, findings


def records(pages: DataFrame, cursor: str, following: str, items: str, source: str | None = None) -> DataFrame:
    """``source, nth, at, item`` of the pages in order; ``items`` is an array, and a page that stands several times gives its items once."""
    order, _ = chained(pages, cursor, following, source)
    src = F.col(source) if source else F.lit("")
    pick = Window.partitionBy("source", "cursor").orderBy("f", F.xxhash64("items"))
    rows = pages.select(src.alias("source"), F.coalesce(cursor, F.lit("")).alias("cursor"), F.col(following).alias("f"), F.col(items).alias("items"))
    rows = rows.withColumn("k", F.row_number().over(pick)).where("k = 1")
    return rows.join(order, ["source", "cursor"]).select("source", "nth", F.posexplode("items").alias("at", "item"))


def companies(target: DataFrame, files: DataFrame) -> DataFrame:
    """``code, cn, en, short, origin``: one company of each code, those of the target before those of files; without a code one of each name.

    Both sides have ``code, cn, en, short, rank`` (``rank`` orders a side's rows).  Of
    each field the first value counts, the target's before the files'; a row of files without a code
    gives way to a company of the target with the same name in small letters.
    """
    side = lambda df, origin, at: df.select(F.nullif(F.ltrim(F.upper(F.trim("code")), F.lit("0")), F.lit("")).alias("code"), "cn", "en", "short", F.lit(origin).alias("origin"), F.struct(F.lit(at).alias("side"), F.col("rank").cast("long").alias("rank")).alias("o"))
    both = side(target, "target", 0).unionByName(side(files, "files", 1))
    name = F.lower(F.regexp_replace(F.coalesce("cn", "en", "short"), r"\s", ""))
    keyed = both.withColumn("name", name).where("code is not null or name is not null")
    # A name of the target stands for its company, whatever code it has there.
    owners = keyed.where("o.side = 0 and name is not null").groupBy("name").agg(F.min_by("code", "o").alias("owner_code"), F.lit(True).alias("owned"))
    keyed = keyed.join(owners, "name", "left")
    key = F.when(F.col("code").isNotNull(), F.concat(F.lit("c:"), "code")).when(F.col("owned") & F.col("owner_code").isNotNull(), F.concat(F.lit("c:"), "owner_code")).otherwise(F.concat(F.lit("n:"), "name"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("o"))).alias(c)
    return keyed.withColumn("key", key).groupBy("key").agg(F.when(F.first("key").startswith("c:"), F.substring(F.first("key"), 3, 100)).alias("code"), first("cn"), first("en"), first("short"), F.min_by("origin", "o").alias("origin")).drop("key")
