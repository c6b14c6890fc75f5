"""Facts and what they rest on: quotes that must occur, weeks, deals and questions put together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def text_key(text: Column) -> Column:
    """Small letters and single spaces, for comparing quotes."""
    return F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))


def quotes_checked(facts: DataFrame, messages: DataFrame, message: str, quote: str, text: str, most: int = 400) -> DataFrame:
    """``facts`` with ``verified`` and ``problem``: a quote must stand in the message it names."""
    bodies = messages.select(message, text_key(F.col(text)).alias("body"), F.lit(True).alias("there"))
    rows = facts.join(bodies, message, "left")
    asked = text_key(F.col(quote))
    found = F.coalesce(F.col("body").contains(asked), F.lit(False))
    problem = (
        F.when(F.coalesce(F.length(F.trim(quote)), F.lit(0)) == 0, "empty quote").when(F.length(quote) > most, "over-long quote")
        .when(F.col("there").isNull(), "no such message").when(~found, "quote not found")
    )
    return rows.select(*[F.col(c) for c in facts.columns], problem.isNull().alias("verified"), problem.alias("problem"))


def provenance(rows: DataFrame, key: str, quote: str, order: str, most: int = 3) -> DataFrame:
    """``key, lines``: the first ``most`` quotes of each record, as a list for people to read."""
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(order, quote))).where(F.col("nth") <= most)
    listed = F.array_sort(F.collect_list(F.struct("nth", F.col(quote).alias("q"))))
    return first.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: F.concat(F.lit("“"), x["q"], F.lit("”"))), "\n").alias("lines"))


def done_later(tasks: DataFrame, quotes: DataFrame, key: str, stamp: str) -> DataFrame:
    """``tasks`` with ``done``: only a quote from a later mail than the task's own closes it."""
    last = quotes.groupBy(key).agg(F.max(stamp).alias("last_quote"))
    return tasks.join(last, key, "left").withColumn("done", F.coalesce(F.col("last_quote") > F.col(stamp), F.lit(False))).drop("last_quote")


def same_as(rows: DataFrame, key: str, answers: DataFrame) -> DataFrame:
    """``rows`` with ``key`` replaced where ``answers`` (``key, same_as``) say that two records are one; aggregate again afterwards."""
    once = answers.groupBy(key).agg(F.max("same_as").alias("same_as"))
    return rows.join(once, key, "left").withColumn(key, F.coalesce("same_as", key)).drop("same_as")


def weeks(days: DataFrame, owner: str, day: str, plan: str) -> DataFrame:
    """``owner, year, week, days, plan``: one row for each owner and ISO week; days once and in order, each plan once unless a longer one holds it."""
    rows = days.where(F.col(day).isNotNull()).select(F.col(owner), F.col(day).alias("d"), F.col(plan).alias("p"))
    rows = rows.withColumn("year", F.expr("extract(yearofweek from d)")).withColumn("week", F.weekofyear("d"))
    told = F.transform(F.array_sort(F.collect_set(F.when(F.trim("p") != "", F.struct("d", "p")))), lambda x: x["p"])
    fold = F.aggregate(F.array_distinct(told), F.lit(""), lambda a, x: F.when(a.contains(x), a).when(a == "", x).otherwise(F.concat(a, F.lit("\n"), x)))
    return rows.groupBy(owner, "year", "week").agg(F.array_sort(F.collect_set("d")).alias("days"), fold.alias("plan"))


def questions(names: DataFrame, key: str, name: str, candidates: DataFrame, score: str, most: int = 3) -> DataFrame:
    """One row for each folded name: its first spelling, how often it occurs and its best candidates, as one question."""
    asked = names.groupBy(key).agg(F.min(name).alias(name), F.count("*").alias("rows"))
    best = candidates.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), "candidate"))).where(F.col("nth") <= most)
    listed = best.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "candidate"))), lambda x: x["candidate"]).alias("candidates"))
    return asked.join(listed, key, "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))


def deals(documents: DataFrame, deal: str, order: str) -> DataFrame:
    """``deal`` with the first total, the latest delivery, its documents and messages."""
    first = F.min_by("total", F.when(F.col("total").isNotNull(), F.struct(order, "sha256")))
    return documents.groupBy(deal).agg(first.alias("total"), F.max("delivery").alias("delivery"), F.array_sort(F.collect_set("sha256")).alias("documents"), F.array_sort(F.collect_set("message_id")).alias("messages"))


def document_fields(text: Column, kinds: Mapping[str, tuple[str, Mapping[str, str]]]) -> Column:
    """``kind, fields`` of the first kind whose marker occurs; a field is the first group of its pattern, null where it is missing."""
    kind, fields = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    for name, (marker, patterns) in reversed(list(kinds.items())):
        pairs = [x for f, p in patterns.items() for x in (F.lit(f), F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit("")))]
        there = text.rlike(marker)
        kind, fields = F.when(there, F.lit(name)).otherwise(kind), F.when(there, F.create_map(*pairs)).otherwise(fields)
    return F.struct(kind.alias("kind"), fields.alias("fields"))


def stratified(rows: DataFrame, stratum: Sequence[str], key: str, each: int, seed: int = 0) -> DataFrame:
    """``each`` rows of every stratum, drawn by a seeded hash of their key: the same for any partitioning."""
    order = Window.partitionBy(*stratum).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each).drop("nth")


def failed_checks(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``check, bad``: how many rows break each rule, in one pass."""
    counts = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("bad")) for n in checks])).alias("x")).select("x.*")


def body(title: Column, **parts: Column) -> Column:
    """The text of a record: a title and a labelled line for each part that is there; empty ones leave no line."""
    lines = [F.when(F.trim(c.cast("string")) != "", F.concat(F.lit(f"{label.replace('_', ' ')}: "), c.cast("string"))) for label, c in parts.items()]
    return F.concat_ws("\n", title, *lines)


def case_texts(messages: DataFrame, case: str, order: str, alias: str, top: str) -> DataFrame:
    """``case, text``: a case's messages in order as one text to read, each under its alias."""
    shown = F.concat(F.lit("## "), F.col(alias), F.lit("\n"), F.coalesce(F.nullif(F.trim(top), F.lit("")), F.lit("(no new text)")))
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(alias).alias("a"), shown.alias("t"))))
    return messages.groupBy(case).agg(F.array_join(F.transform(listed, lambda x: x["t"]), "\n\n").alias("text"))
