"""URL filters as a temporal list join.

Dated list entries become validity intervals: an entry holds from its date until
the next entry for the same pattern.  Every capture is judged by the entries
that were active when it was fetched; the most specific pattern decides.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Patterns from broad to narrow: a domain with all below it, one host, a path of one host.
SCOPES = ("domain", "host", "path")


def host_of(url: Column) -> Column:
    """Lower-case host without port, user and final dot; null where there is none."""
    return F.nullif(F.rtrim(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """``key, action, listed_on, until`` (exclusive, null: still active) from ``scope, pattern, action, listed_on``.

    Hosts are compared in small letters, paths as they are written; a final slash
    of a path makes no difference.  Of several actions for one pattern and date,
    ``block`` wins.  Entries with a null in any of the four, or an unknown scope,
    are no entries.
    """
    at = F.locate("/", F.col("pattern"))
    host = F.rtrim(F.lower(F.when((F.col("scope") == "path") & (at > 0), F.substring_index("pattern", "/", 1)).otherwise(F.col("pattern"))), F.lit("."))
    path = F.when((F.col("scope") == "path") & (at > 0), F.rtrim(F.expr("substring(pattern, locate('/', pattern))"), F.lit("/"))).otherwise(F.lit(""))
    key = F.concat(F.substring("scope", 1, 1), F.lit(":"), host, path)
    known = entries.where(F.col("scope").isin(*SCOPES) & F.col("pattern").isNotNull() & F.col("action").isNotNull() & F.col("listed_on").isNotNull())
    dated = known.groupBy(key.alias("key"), "listed_on").agg(F.max_by("action", F.struct(F.col("action") == "block", "action")).alias("action"))
    return dated.withColumn("until", F.lead("listed_on").over(Window.partitionBy("key").orderBy("listed_on")))


def keys_of(url: Column) -> Column:
    """``rank, key`` for every pattern that could match a URL, higher ranks being narrower."""
    host = host_of(url)
    labels, parts = F.split(host, "\\."), F.split(F.rtrim(path_of(url), F.lit("/")), "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct((F.size(labels) - i + 1).alias("rank"), F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")).alias("key")))
    paths = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct((i + 2000).alias("rank"), F.concat(F.lit("p:"), host, F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("key")))
    own = F.array(F.struct(F.lit(1000).alias("rank"), F.concat(F.lit("h:"), host).alias("key")))
    return F.when(host.isNotNull(), F.concat(domains, own, paths))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", key: str = "page_id", salts: int = 16, broadcast_rows: int = 100_000) -> DataFrame:
    """``key, url, fetched, verdict, matched, listed_on, n_captures`` for every distinct capture.

    ``verdict`` is the action of the narrowest pattern active at ``fetched``
    (``listed_on <= fetched < until``), ``none`` without one; ``matched`` is that
    pattern with its scope.  Captures equal in all three columns are one row and
    are counted.  A null or unreadable URL and a null time match nothing; an empty
    list leaves every capture at ``none``; further columns are ignored.

    A list of at most ``broadcast_rows`` intervals is counted and then broadcast.
    A longer one is joined on its key and a salt, so that one host with a third
    of all captures is spread over ``salts`` groups, which Spark may split further.
    """
    base = captures.select(F.col(f"`{key}`").alias("key_"), F.col(f"`{url}`").alias("url_"), F.col(f"`{fetched}`").alias("at_"))
    base = base.groupBy("key_", "url_", "at_").agg(F.count("*").alias("n_captures"))
    held = stored(intervals(entries), "intervals")
    small = held.limit(broadcast_rows + 1).count() <= broadcast_rows
    probes = base.select("key_", "url_", "at_", F.explode(keys_of(F.col("url_"))).alias("k")).select("key_", "url_", "at_", "k.rank", "k.key")
    active = (F.col("listed_on") <= F.col("at_")) & (F.col("until").isNull() | (F.col("at_") < F.col("until")))
    if small:
        hits = probes.join(F.broadcast(held), "key").where(active)
    else:
        spread = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = probes.withColumn("salt", F.pmod(F.xxhash64("key_", "url_", "at_"), F.lit(salts)).cast("int"))
        hits = salted.join(spread, ["key", "salt"]).where(active)
    best = F.struct("rank", "listed_on", "action", "key")
    judged = hits.select("key_", "url_", "at_", best.alias("best"), F.lit(0).cast("long").alias("n_captures"))
    every = base.select("key_", "url_", "at_", F.lit(None).cast(judged.schema["best"].dataType).alias("best"), "n_captures")
    out = every.unionByName(judged).groupBy("key_", "url_", "at_").agg(F.max("best").alias("best"), F.sum("n_captures").alias("n_captures"))
    return out.select(
        F.col("key_").alias(key), F.col("url_").alias(url), F.col("at_").alias(fetched),
        F.coalesce("best.action", F.lit("none")).alias("verdict"), F.col("best.key").alias("matched"), F.col("best.listed_on").alias("listed_on"), "n_captures",
    )
