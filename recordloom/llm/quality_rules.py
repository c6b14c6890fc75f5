"""Quality rules: learned decision lists over text statistics.

Everything that touches documents is a DataFrame expression.  Sequential
covering grows and prunes threshold conjunctions on a bounded sample of labelled
statistics; the rules come out as one ordered ``CASE`` expression, which Spark
evaluates for every document in a single pass without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: what counts as a symbol.
SYMBOLS = "#*$%&|<>"

FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "marks_per_word",
    "distinct_share",
)


def _count_of(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def _once(value: Column) -> Column:
    """``value``, marked so that no filter is pushed below it: a filter there would compute it again for every word."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _covered(hashes: Column) -> Column:
    """Words inside windows (three words each, one hash per window) that occur twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def count(p: Column) -> Column:
        places = F.transform(p, lambda x, k: F.when((F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]), x["i"]))
        places = F.sort_array(F.filter(places, lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(places, start, step, lambda a: a["n"])

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(pairs, count))


def text_statistics(docs: DataFrame, text: str = "text", key: str = "doc_id", row: bool = False) -> DataFrame:
    """One row per document: ``key``, the contract's counts and the learner's features.

    Null and empty texts have zero words and zero features.  Very long texts stay
    one row; nothing is exploded or shuffled.  Repeated rows stay repeated rows;
    other columns are dropped, so clashing names in ``docs`` do no harm.
    Windows are compared by a 64-bit hash of their three words within one text.
    With ``row``, the whole row comes along as the struct ``row``.
    """
    more = ["row"] if row else []
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if row else []
    text = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    base = docs.select(
        F.col(f"`{key}`").alias("key"),
        *whole,
        _once(words).alias("words"),
        lines.alias("lines"),
        _count_of(text, SYMBOLS).alias("n_symbols"),
        _count_of(text, "A-Z").alias("n_upper"),
        _count_of(text, "0-9").alias("n_digits"),
        _count_of(text, "!?").alias("n_marks"),
    )
    w = F.col("words")
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    hashes = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)).otherwise(F.array().cast("array<bigint>"))
    base = base.select(
        "key",
        *more,
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        "n_symbols", "n_upper", "n_digits", "n_marks",
        F.size(w).cast("long").alias("n_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _once(hashes).alias("hashes"),
    )
    base = base.withColumn("n_repeat_words", _once(_covered(F.col("hashes")))).drop("hashes")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return base.select(
        F.col("key").alias(key),
        *more,
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word_chars"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_marks", "n_words").alias("marks_per_word"),
        share("n_distinct", "n_words").alias("distinct_share"),
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(feature, "<=" or ">", threshold)`` that rejects."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, cut in self.tests:
            out = out & (F.col(name) <= F.lit(cut) if op == "<=" else F.col(name) > F.lit(cut))
        return out

    def holds(self, row: dict) -> bool:
        return all(row[n] <= c if op == "<=" else row[n] > c for n, op, c in self.tests)

    def __str__(self) -> str:
        return " and ".join(f"{n} {op} {c:g}" for n, op, c in self.tests)


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> list[dict]:
    """Statistics of at most ``bound`` labelled documents, the ones with the least hash of their id."""
    picked = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("quality").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    # At most ``bound`` rows of two numbers, so it is safe to broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    stats = text_statistics(rows).join(F.broadcast(picked), "doc_id")
    return [r.asDict() for r in stats.select("doc_id", "good", *FEATURES).collect()]


def evidence(bad: int, good: int, rate: float) -> float:
    """Likelihood-ratio statistic of a rule that covers ``bad`` and ``good`` rows where a share ``rate`` of all rows is bad (one degree of freedom)."""
    n = bad + good
    part = lambda seen, expected: seen * math.log(seen / expected) if seen else 0.0
    return 2 * (part(bad, n * rate) + part(good, n * (1 - rate)))


def learn_rules(rows: list[dict], max_rules: int = 12, max_tests: int = 3, cuts: int = 64, precision: float = 0.97, least: int = 5, significance: float = 10.83) -> list[Rule]:
    """Sequential covering for ``good == 0``.

    Two thirds of the rows grow a rule test by test (FOIL's gain); the rest prune
    it from its end and decide whether it stays: at least ``precision`` of all the rows it covers
    are bad, and on the rows that growing has not seen its :func:`evidence` against the
    share of bad rows passes ``significance`` (10.83 is one chance in a thousand), so
    few labels ask for a purer rule and no count of them switches the method off.
    Covered rows go, and the next rule is grown.
    """
    if not rows:
        return []
    edges = {}
    for f in FEATURES:
        values = sorted({r[f] for r in rows})
        step = max(1, len(values) / cuts)
        at = sorted({int(k * step) for k in range(cuts) if int(k * step) + 1 < len(values)})
        edges[f] = [((values[k] + values[k + 1]) / 2, (values[k + 1] - values[k]) / (values[-1] - values[0])) for k in at]
    ordered = sorted(rows, key=lambda r: (r["doc_id"] * 2654435761) % 2**32)
    grow, prune = [r for k, r in enumerate(ordered) if k % 3], [r for k, r in enumerate(ordered) if not k % 3]
    rules: list[Rule] = []

    def counts(part: list[dict], rule: Rule) -> tuple[int, int]:
        got = [r["good"] for r in part if rule.holds(r)]
        return sum(1 for g in got if not g), sum(1 for g in got if g)

    rate = sum(1 for r in rows if not r["good"]) / len(rows)

    def sure(rule: Rule) -> bool:
        seen, unseen = counts(grow, rule), counts(prune, rule)
        bad, good = seen[0] + unseen[0], seen[1] + unseen[1]
        return bad >= precision * (bad + good) and unseen[0] > rate * sum(unseen) and evidence(*unseen, rate) > significance

    def best_test(part: list[dict]) -> tuple[float, tuple | None]:
        p0, n0 = sum(1 for r in part if not r["good"]), sum(1 for r in part if r["good"])
        best, test = (0.0, 0.0), None
        for f in FEATURES:
            ranked = sorted((r[f], r["good"]) for r in part)
            k = p = n = 0
            for cut, gap in edges[f]:
                while k < len(ranked) and ranked[k][0] <= cut:
                    p, n, k = p + (not ranked[k][1]), n + bool(ranked[k][1]), k + 1
                for op, a, b in (("<=", p, n), (">", p0 - p, n0 - n)):
                    gain = a * (math.log2(a / (a + b)) - math.log2(p0 / (p0 + n0))) if a >= least else 0.0
                    # Of equal gains the cut in the widest gap of its feature's range.
                    if gain > 0 and (round(gain, 6), gap) > best:
                        best, test = (round(gain, 6), gap), (f, op, cut)
        return best[0], test

    while len(rules) < max_rules:
        tests, part = [], grow
        while len(tests) < max_tests and any(r["good"] for r in part) and any(not r["good"] for r in part):
            _, test = best_test(part)
            if test is None:
                break
            tests.append(test)
            part = [r for r in part if Rule((test,)).holds(r)]
        if not tests:
            break
        worth = lambda rule: (lambda p, n: (p - n) / (p + n) if p + n else -1.0)(*counts(prune, rule))
        rule = max((Rule(tuple(tests[:k])) for k in range(len(tests), 0, -1)), key=worth)
        rule = next((r for r in (rule, Rule(tuple(tests))) if sure(r)), None)
        if rule is None:
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not rule.holds(r)] for part in (grow, prune))
    return rules


def decision(rules: list[Rule]) -> Column:
    """The first rule that holds, counted from 1; 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(rule.column(), F.lit(k)) if out is None else out.when(rule.column(), F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def apply_rules(docs: DataFrame, rules: list[Rule], text: str = "text", key: str = "doc_id", row: bool = False) -> DataFrame:
    """Statistics, ``base_failed``, ``rule`` (0: none) and ``kept`` for every document."""
    stats = text_statistics(docs, text, key, row)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed).withColumn("rule", decision(rules))
    return stats.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """Learn a decision list from at most ``max_labelled`` labelled rows and apply it to all of ``docs``.

    Empty ``labels`` give an empty list: only the base rules reject then.  Labels
    of unknown documents and labels without a quality are ignored; of several
    labels for a document the best counts.
    """
    return apply_rules(docs, learn_rules(labelled_sample(docs, labels, max_labelled)))


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with their columns as they are."""
    rules = learn_rules(labelled_sample(docs, labels, max_labelled))
    return apply_rules(docs, rules, row=True).where("kept").select("row.*")
