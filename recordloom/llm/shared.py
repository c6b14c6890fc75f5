"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_KEPT: dict[Hashable, Any] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only a local session may do without the setting (tests); a cluster without
    it has no folder that all executors see, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="recordloom-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage,
    and a lost executor costs nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from one task to the next: only what was asked for last.  A worker runs tasks of many stages and would else hold what all of them keep."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Drop what earlier tasks of this worker kept; for tasks that need the memory and keep nothing."""
    _KEPT.clear()
