"""Secret scans: regular expressions behind a trigram inverted index.

Each rule's expression is turned into the trigrams that a match must hold.
Postings of those trigrams (and of no others) are written for all texts, the
postings of a rule are intersected, and only the texts that are left are matched.
A rule without mandatory trigrams is matched against every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .trigrams import required


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` from left to right, without those whose ``group`` has under ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


#: Fixed by the contract, in its order.  A run of hexadecimal digits or of capitals and digits is followed to its end, so its length can stand in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further kinds with forms of their own.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]{0,30}PRIVATE\x20KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9._~+/=-]+)", 20, 1),
    Rule("login", r"[a-z]{2,10}://[^\x00-\x20/:@]{1,64}:([^\x00-\x20/:@]{1,64})@"),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def running_sum(values: Column) -> Column:
    """Sums of an array of longs up to each place, by doubling: time n log n for any length, where folding into an array takes n²."""
    steps = F.array(*[F.lit(1 << k) for k in range(31)])
    add = lambda a, s: F.when(F.size(a) > s, F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - s), F.lit(0)))).otherwise(a)
    return F.aggregate(steps, values, add)


def spans(text: Column, rule: Rule, order: int) -> Column:
    """``array<struct<start, kind order, end>>`` of a rule's matches, in code points, end exclusive.

    The text between matches and the matches take turns, so the sum of both up to
    a match is its end.
    """
    sizes = lambda column: F.transform(column, lambda m: F.length(m).cast("long"))
    all_of = lambda group: sizes(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)))
    gaps = sizes(F.split(text, rule.pattern, -1))

    def placed(m: Column) -> Column:
        ends = running_sum(F.zip_with(F.slice(gaps, 1, F.size(m)), m, lambda a, b: a + b))
        return F.zip_with(ends, m, lambda e, n: F.struct((e - n).alias("start"), F.lit(order).alias("nth"), e.alias("end")))

    out = _let(all_of(0), placed)
    if rule.group:
        both = F.zip_with(out, all_of(rule.group), lambda s, n: F.struct(s.alias("s"), n.alias("n")))
        out = F.transform(F.filter(both, lambda x: x["n"] >= rule.least), lambda x: x["s"])
    none = F.array().cast("array<struct<start:bigint,nth:int,end:bigint>>")
    return F.when(text.rlike(rule.pattern), out).otherwise(none)


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``trigram, h``: which texts (by a 64-bit hash) hold which trigrams of ``vocabulary``, in small letters.

    Two texts of one hash share their postings, which can only add candidates.
    Copies of a text are one posting each.
    """
    texts = docs.select(F.xxhash64("text").alias("h"), F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return texts.select(F.explode(held).alias("trigram"), "h").distinct()


def candidates(index: DataFrame, demands: dict[int, list]) -> DataFrame:
    """``h, rules``: the texts that meet all demands of a rule, with the numbers of those rules.

    Postings of an alternative are intersected by the bits of its trigrams; those bits are
    joined in the tasks first, so a trigram in a third of all texts makes no hot key.
    """
    asked = [
        (t, rule, d, a, 1 << k, (1 << len(alternative)) - 1)
        for rule, whole in demands.items()
        for d, one in enumerate(whole)
        for a, alternative in enumerate(sorted(map(sorted, one)))
        for k, t in enumerate(alternative)
    ]
    n_demands = [(rule, len(whole)) for rule, whole in demands.items()]
    spark = index.sparkSession
    # Both tables are as long as the rules are, not as the texts: safe to broadcast.
    asked = spark.createDataFrame(asked, "trigram string, rule int, demand int, alternative int, bit long, all_bits long")
    n_demands = spark.createDataFrame(n_demands, "rule int, n_demands int")
    met = index.join(F.broadcast(asked), "trigram").groupBy("h", "rule", "demand", "alternative", "all_bits").agg(F.bit_or("bit").alias("bits")).where("bits = all_bits")
    passed = met.groupBy("h", "rule").agg(F.count_distinct("demand").alias("n")).join(F.broadcast(n_demands), "rule").where("n = n_demands")
    return passed.groupBy("h").agg(F.collect_set("rule").alias("rules"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``doc_id, found``: for each row of ``docs`` the array of all matches, ``(start, nth, end)`` by place and then by the rules' order.

    A null text is empty; odd texts have an empty array; repeated rows stay
    repeated rows; other columns of ``docs`` do not matter.  Texts are read twice,
    for postings and to be matched, and shuffled only if the candidates are too
    many to be broadcast (Spark goes by the size of their file).
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    demands = {k: required(rule.pattern) for k, rule in enumerate(rules)}
    asked = {k: d for k, d in demands.items() if d}
    rows = texts.withColumn("h", F.xxhash64("text"))
    if asked:
        vocabulary = sorted({t for whole in asked.values() for one in whole for alternative in one for t in alternative})
        index = stored(postings(texts, vocabulary), "postings")
        rows = rows.join(stored(candidates(index, asked), "candidates"), "h", "left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<int>"))
    none = F.array().cast("array<struct<start:bigint,nth:int,end:bigint>>")
    each = [spans(F.col("text"), rule, k) if k not in asked else F.when(F.array_contains("rules", k), spans(F.col("text"), rule, k)).otherwise(none) for k, rule in enumerate(rules)]
    return rows.select("doc_id", F.sort_array(F.concat(*each)).alias("found"))


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``; see :func:`scan`.  ``rules`` begin with :data:`BASE`."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    written = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["nth"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("found", lambda s: s["nth"] == k)).cast("long").alias(f"n_{BASE[k].kind}")
    base = F.filter("found", lambda s: s["nth"] < len(BASE))
    return scan(docs, rules).select("doc_id", *map(count, range(len(BASE))), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
