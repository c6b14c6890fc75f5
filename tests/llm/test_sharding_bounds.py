"""How many shards a round of compaction takes, with very many and very small ones."""

import pytest
from pyspark.sql import functions as F

from recordloom.llm import sharding


def many(spark, n, n_bytes):
    return spark.range(n).select(F.concat(F.lit("s"), "id").alias("shard"), F.lit(1).cast("long").alias("n_rows"), F.lit(n_bytes).cast("long").alias("n_bytes"), F.lit(0).alias("tier"), F.lit(1).cast("long").alias("version"))


@pytest.mark.parametrize(("n", "n_bytes", "most"), [(200_000, 1 << 10, 50_000), (200_000, 1 << 10, 3_000), (5_000, 1 << 20, 100), (7, 1 << 10, 2), (100, 1 << 25, 50_000)])
def test_a_round_is_bounded(spark, n, n_bytes, most):
    picked = sharding.next_runs(many(spark, n, n_bytes), 64 << 20, 4, most)
    assert len(picked) <= most and len({s for s, _ in picked}) == len(picked)
    assert picked or n_bytes >= 32 << 20 or most < 4


def test_rounds_of_few_shards_end(spark, tmp_path):
    """At most four shards a round: all are merged in the end and no row is lost."""
    base = str(tmp_path / "shards")
    rows = spark.range(400).select("id", F.lit("x" * 50).alias("text")).repartition(5)
    sharding.append(rows, base, shard_rows=10)
    before = sharding.manifest(spark, base).count()
    sharding.compact(spark, base, most=4)
    assert before >= 40 and sharding.manifest(spark, base).count() < before / 3
    assert sharding.read(spark, base).select("id").distinct().count() == sharding.read(spark, base).count() == 400
    assert sharding.vacuum(spark, base) >= before
