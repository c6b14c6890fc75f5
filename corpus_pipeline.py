"""The corpus pipeline: documents through five operators to packed token sequences.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and its result is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import decontamination, packing, quality_rules, repeats, simhash
from recordloom.llm.shared import new_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: what the base rules or the learned list reject goes."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup: of texts whose five-word shingles overlap by 0.8 or more the document with the smallest id stays."""
    return simhash.one_of_near_copies(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated strings are cut out; documents with nothing left go."""
    cut = repeats.remove_repeats(docs).where(F.col("text").rlike(r"\S") | (F.length("text") == F.col("n_chars")))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that overlap with an item go."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing into sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_good),
    ("simhash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: Hashing, learning and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
