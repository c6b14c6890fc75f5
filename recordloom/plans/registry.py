"""Where queries and their SQL are put down."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a table reader as the query of its name."""

    def put(function: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return put
