"""Each query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def shown(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.9g}"
    return str(pd.Timestamp(value)) if hasattr(value, "isoformat") else str(value)


def table(frame):
    return sorted("|".join(shown(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql:
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert table(got) == table(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_imports_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) > 40; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent, timeout=120)
