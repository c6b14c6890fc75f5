"""A session with the settings the library counts on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(name: str = "recordloom", cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session, with a new folder for intermediate tables; on a cluster bring your own, with adaptive execution and ``spark.checkpoint.dir`` set."""
    running = SparkSession.getActiveSession()
    folder = running.conf.get("spark.checkpoint.dir", None) if running else None
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="recordloom-"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
