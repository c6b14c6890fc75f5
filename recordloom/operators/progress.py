"""How far a job of several stages has come, counted while its rows are written.

Counts are taken by ``DataFrame.observe`` inside the stage that writes, so no table is
read twice.  A task that runs again after a lost executor counts once where its
first result was lost with it, but a shuffle that is computed again may be counted
again; :meth:`Progress.checked` holds the counts against the tables.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_path

SCHEMA = "stage string, nth int, measure string, value decimal(38,6), seconds double"
_log = logging.getLogger(__name__)


class Progress:
    """Stages in the order in which they end, with what each counted.

    ``told`` is called as each stage begins (``began``) and ends (``ended``, with its counts); what it
    raises is logged and stops nothing.
    """

    def __init__(self, spark: SparkSession, told: Callable[[str, str, Mapping[str, object]], None] | None = None):
        self.spark, self.told = spark, told
        self.rows: list[tuple] = []
        self.tables: dict[str, tuple[DataFrame, dict[str, Column]]] = {}
        self._lock = threading.Lock()

    def _tell(self, stage: str, what: str, counts: Mapping[str, object]) -> None:
        if self.told is None:
            return
        try:
            self.told(stage, what, counts)
        except Exception:  # noqa: BLE001  a listener never stops the job
            _log.exception("progress of %s", stage)

    def stage(self, name: str, df: DataFrame, measures: Mapping[str, Column] | None = None, path: str | None = None) -> DataFrame:
        """``df`` written (to ``path``, else to the shared folder) and read again; ``measures`` are aggregates over its rows.

        ``rows`` is always among them.  Sums over no rows count as zero.  A stage that fails raises as its write
        does and leaves no counts; a name can be used once.
        """
        with self._lock:
            if name in self.tables:
                raise ValueError(f"stage {name} ran before")
            self.tables[name] = (df, {})
        asked = {"rows": F.count(F.lit(1)), **(measures or {})}
        seen = Observation(f"{name}")
        at = path or new_path(self.spark, "stage")
        began = time.monotonic()
        try:
            self._tell(name, "began", {})
            df.observe(seen, *(c.cast("decimal(38,6)").alias(m) for m, c in asked.items())).write.parquet(at)
        except BaseException:
            with self._lock:
                del self.tables[name]
            raise
        took, counts = time.monotonic() - began, seen.get
        out = self.spark.read.schema(df.schema).parquet(at)
        with self._lock:
            nth = len({r[1] for r in self.rows}) + 1
            self.rows += [(name, nth, m, counts[m] if counts.get(m) is not None else 0, took) for m in asked]
            self.tables[name] = (out, asked)
        self._tell(name, "ended", {m: counts.get(m) for m in asked})
        return out

    def report(self) -> DataFrame:
        """``stage, nth, measure, value, seconds`` of the stages that ended: a row for each measure, so a small table."""
        from decimal import Decimal

        with self._lock:
            rows = [(s, n, m, Decimal(v), t) for s, n, m, v, t in self.rows]
        return self.spark.createDataFrame(rows, SCHEMA)

    def checked(self) -> DataFrame:
        """``stage, measure, value, held``: counts that the written tables do not bear out; one pass over each table."""
        with self._lock:
            done = {name: t for name, t in self.tables.items() if t[1]}
        held = None
        for name, (table, asked) in done.items():
            one = table.agg(*(F.coalesce(c.cast("decimal(38,6)"), F.lit(0)).cast("decimal(38,6)").alias(m) for m, c in asked.items()))
            one = one.select(F.lit(name).alias("stage"), F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").alias("held")) for m in asked))))
            held = one if held is None else held.unionByName(one)
        if held is None:
            return self.spark.createDataFrame([], "stage string, measure string, value decimal(38,6), held decimal(38,6)")
        both = self.report().select("stage", "measure", "value").join(held, ["stage", "measure"])
        return both.where("value <> held")
