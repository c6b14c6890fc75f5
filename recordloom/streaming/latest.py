"""Records that arrive over time: the newest of each key, never an older one over a newer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.planning import decide


def first_of_each(stream: DataFrame, key: Sequence[str], event_time: str, late: str = "1 hour") -> DataFrame:
    """A stream without repeated keys; state is dropped once the watermark has passed."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(key))


def windowed_counts(stream: DataFrame, event_time: str, key: Sequence[str], width: str, late: str = "1 hour") -> DataFrame:
    """Counts per window and key; rows later than the watermark are left out."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, width), *key).agg(F.count("*").alias("n"))


def newest_state(held: DataFrame | None, batch: DataFrame, key: str, stamp: str) -> DataFrame:
    """The target after a batch: for each key the row with the latest stamp, held rows winning ties."""
    rows = batch.withColumn("held_", F.lit(0))
    if held is not None:
        rows = held.withColumn("held_", F.lit(1)).unionByName(rows)
    columns = [c for c in rows.columns if c != "held_"]
    return rows.groupBy(F.col(key).alias("key_")).agg(F.max_by(F.struct(*columns), F.struct(stamp, "held_")).alias("row")).select("row.*")


class LatestSink:
    """For ``foreachBatch``: keeps a versioned target in ``path`` and writes each batch's plan beside it.

    Every batch makes the next version from the newest whole one, whatever its
    number, so a gap in the numbers loses nothing.  A batch that is delivered again finds its
    version and changes nothing.  ``run`` names the checkpoint: a query that starts from
    a new checkpoint counts from zero again and needs a new name, and then goes on
    from the target as it is.  A batch past the first of its run whose run has left no
    version stops with an error instead of starting from nothing.  The last ``keep`` versions stay.
    """

    def __init__(self, path: str, key: str, stamp: str, fields: Sequence[str], run: str = "run", keep: int = 3) -> None:
        if not run.isalnum():
            raise ValueError("run is made of letters and digits")
        self.path, self.key, self.stamp, self.fields, self.run, self.keep = path.rstrip("/"), key, stamp, list(fields), run, max(2, keep)

    def _fs(self, spark, path: str):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark) -> list[tuple[int, str, int]]:
        """``version, run, batch`` of the whole versions, oldest first."""
        at, fs = self._fs(spark, f"{self.path}/state")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        whole = [n.split("-") for n in names if fs.exists(self._fs(spark, f"{self.path}/state/{n}/_SUCCESS")[0])]
        return sorted((int(v), run, int(batch)) for v, run, batch in whole)

    def target(self, spark) -> DataFrame | None:
        """The newest version; none before the first batch."""
        known = self.versions(spark)
        return spark.read.parquet(f"{self.path}/state/{_name(*known[-1])}") if known else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, known = batch.sparkSession, self.versions(batch.sparkSession)
        if (self.run, batch_id) in {(run, b) for _, run, b in known}:
            return
        if batch_id and not any(run == self.run for _, run, _ in known):
            raise FileNotFoundError(f"batch {batch_id} of run {self.run}: no version of this run in {self.path}")
        name = _name(known[-1][0] + 1 if known else 0, self.run, batch_id)
        held = self.target(spark)
        # The batch is read once; plan and target both come from what was written.
        newest_state(None, batch, self.key, self.stamp).write.mode("overwrite").parquet(f"{self.path}/batch/{name}")
        newest = spark.read.schema(batch.schema).parquet(f"{self.path}/batch/{name}")
        before = newest.limit(0) if held is None else held
        decide(newest, before, self.key, self.stamp, self.fields).write.mode("overwrite").parquet(f"{self.path}/plan/{name}")
        newest_state(held, newest, self.key, self.stamp).write.mode("overwrite").parquet(f"{self.path}/state/{name}")
        for old in known[: max(0, len(known) + 1 - self.keep)]:
            for folder in ("state", "batch"):
                at, fs = self._fs(spark, f"{self.path}/{folder}/{_name(*old)}")
                fs.delete(at, True)


def _name(version: int, run: str, batch: int) -> str:
    return f"{version:012d}-{run}-{batch}"
