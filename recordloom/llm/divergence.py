"""Source divergence audit: how far each source's use of terms is from the others' of its language.

Counts of a term in all sources of a language are one row, a vector with a place
for each source.  Higher-order functions turn a vector into the differences of
its pairs of places, and sums over terms are aggregated in the tasks before they
are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Fixed by the contract: what separates terms, the weight added to each count, and the unit of shares.
SEPARATORS = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
PRIOR, UNIT = 5, 1_000_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms_of(text: Column) -> Column:
    """The terms of a text in order; only A to Z are lower-cased (``lower`` does just that where all characters are ASCII)."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """``1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * n_terms))``, exact: the product is a decimal of 30 digits."""
    part = (count + PRIOR).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", part, (total + PRIOR * n_terms).cast("decimal(19,0)"))


def term_vectors(docs: DataFrame, least: int = 30) -> DataFrame:
    """``lang, term, counts`` (source to occurrences) of the terms in at least ``least`` documents of their language.

    One scan: each document gives its terms, and once more each distinct one, so
    that occurrences and documents are counted together.  Both are summed in the
    tasks first; a source or term with a third of all rows is one row a task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    name = lambda c: F.coalesce(c, F.lit("")).alias(c)
    found = docs.select(name("lang"), name("source"), terms_of(text).alias("terms"))
    weighed = lambda terms, n, n_docs: F.struct(F.lit(n).alias("n"), F.lit(n_docs).alias("n_docs"), terms.alias("terms"))
    both = F.array(weighed(F.col("terms"), 1, 0), weighed(F.array_distinct("terms"), 0, 1))
    found = found.select("lang", "source", F.inline(both)).select("lang", "source", "n", "n_docs", F.explode("terms").alias("term"))
    by_source = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    entries = F.map_from_entries(F.collect_list(F.struct("source", "n")))
    return by_source.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), entries.alias("counts")).where(F.col("n_docs") >= least).drop("n_docs")


def divergence(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group (language and source) every other source of the language
    (part ``pair``) and its ``top`` terms above the language's share (part ``term``).

    Null text, language and source are empty strings, which are groups like any
    other; a group without terms has the shares that zero counts give.  Repeated
    rows count as documents of their own.  A language without kept terms has pairs
    of value 0.  No documents, no rows.  A vector is as wide as its language has
    sources; pairs of sources are the result's own size.
    """
    vectors = stored(term_vectors(docs, least), "term-vectors")
    sums = vectors.select("lang", F.explode("counts").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = vectors.groupBy("lang").agg(F.count("*").alias("n_terms"))
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    groups = groups.join(sums, ["lang", "source"], "left").select("lang", F.struct("source", F.coalesce("n", F.lit(0)).alias("n")).alias("g"))
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list("g")).alias("groups"), F.sum("g.n").alias("total"))
    # One row a language, as a file: Spark knows its size and broadcasts it or not.
    langs = stored(langs.join(kept, "lang", "left").select("lang", "groups", "total", F.coalesce("n_terms", F.lit(0)).alias("n_terms")), "languages")

    count = lambda g: F.coalesce(F.element_at("counts", g["source"]), F.lit(0))
    shares = F.transform("groups", lambda g: F.struct(count(g).alias("n"), share(count(g), g["n"], F.col("n_terms")).alias("p")))
    everywhere = F.aggregate(F.map_values("counts"), F.lit(0).cast("long"), lambda a, n: a + n)
    wide = vectors.join(langs, "lang").select("lang", "term", share(everywhere, F.col("total"), F.col("n_terms")).alias("q"), shares.alias("shares"))

    places = wide.select("lang", F.posexplode("shares").alias("i", "own"), "shares")
    behind = F.slice("shares", F.col("i") + 2, F.size("shares"))
    differences = F.transform(behind, lambda other, k: F.struct((F.col("i") + 1 + k).alias("j"), F.abs(F.col("own.p") - other["p"]).alias("f")))
    summed = places.select("lang", "i", F.inline(differences)).groupBy("lang", "i", "j").agg(F.sum("f").alias("f"))
    sources = langs.select("lang", F.posexplode("groups.source").alias("i", "source"), F.col("groups.source").alias("all"))
    couples = sources.select("lang", "i", "source", F.posexplode("all").alias("j", "item")).where("i <> j")
    couples = couples.withColumns({"a": F.least("i", "j"), "b": F.greatest("i", "j")})
    pairs = couples.join(summed.select("lang", F.col("i").alias("a"), F.col("j").alias("b"), "f"), ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("f", F.lit(0)).alias("value"))

    above = wide.select("lang", "term", "q", F.posexplode("shares").alias("i", "own")).where("own.n > 0 and own.p > q")
    order = (F.col("value").desc(), F.col("item"))
    above = above.select("lang", "i", F.col("term").alias("item"), (F.col("own.p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "i").orderBy(*order))).where(F.col("rank") <= top)
    terms = above.join(sources.select("lang", "i", "source"), ["lang", "i"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return ranked.unionByName(terms)
