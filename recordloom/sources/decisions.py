"""Answers that people gave, and other small JSON inputs.

Answers are a log: each save adds files of its own, which Spark's commit makes
visible as a whole, and the last answer to a question counts.  So writers need no
lock, none overwrites another, and what was answered before stays readable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ANSWERS = "question string, answer string, author string, answered_at timestamp"


def side_input(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, broken)`` of the JSON lines in ``path``; no file is an empty table, and a line that is no JSON is a broken one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema), spark.createDataFrame([], "line string")
    read = spark.read.text(path).where(F.trim("value") != "")
    parsed = read.select("value", F.from_json("value", f"{schema}, broken__ string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken__"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r.broken__").isNotNull()
    return parsed.where(~bad).select("r.*").drop("broken__"), parsed.where(bad).select(F.col("value").alias("line"))


def remember(answers: DataFrame, path: str) -> None:
    """Add ``answers`` (``ANSWERS``) to the log; a question without a name is no question."""
    answers.where("question is not null").select("question", "answer", "author", "answered_at").write.mode("append").json(path)


def answers(spark: SparkSession, path: str) -> DataFrame:
    """The last answer to each question; of answers at one time the greatest, and a null answer takes the one before it back."""
    log, _ = side_input(spark, path, ANSWERS)
    last = log.groupBy("question").agg(F.max(F.struct("answered_at", "answer", "author")).alias("a"))
    return last.where("a.answer is not null").select("question", "a.answer", "a.author", "a.answered_at")


def suggestions(candidates: DataFrame, key: str, candidate: str, score: str, least: float = 0.85) -> DataFrame:
    """``key, candidate``: the best candidate of each open question if it scores ``least`` or more, so that one click answers it; of equals the lesser name."""
    best = candidates.groupBy(key).agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(candidate).alias("c"))).alias("b"))
    return best.where(F.col("b.s") <= -least).select(key, F.col("b.c").alias(candidate))
