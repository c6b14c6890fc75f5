"""Intermediate tables of iterative operators, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in ``spark.checkpoint.dir``; local sessions without the setting use a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="recordloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_rows(batches: Iterable[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that a task's Python never holds what it makes of ten thousand messages at once."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
