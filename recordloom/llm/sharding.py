"""Sharding with size-tiered compaction and versioned manifests.

Arrivals are appended as small immutable shards.  Compaction looks at the
manifest alone, takes shards of one size tier together until a run reaches the
target size, rewrites those runs, and commits the next manifest by one rename.
Readers take the shards that the newest manifest names, so they see all of a
commit or nothing of it; shards of older versions stay until :func:`vacuum`.
DataFrame operations only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "shard string, n_rows long, n_bytes long, tier int, version long"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, base: str) -> int:
    """0 for a store without a manifest."""
    _, at, fs = _fs(spark, f"{base}/versions")
    if not fs.exists(at):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return max((int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()), default=0)


def _marker(spark: SparkSession, base: str, version: int) -> dict:
    """What a commit says: the folder of its manifest and the schema of the rows."""
    text = spark.read.text(f"{base}/versions/v{version:012d}", wholetext=True).first()
    return json.loads(text.value)


def manifest(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    version = current_version(spark, base) if version is None else version
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{base}/{_marker(spark, base, version)['manifest']}")


def schema_of(spark: SparkSession, base: str, version: int | None = None) -> StructType:
    """The schema of the rows of a version."""
    version = current_version(spark, base) if version is None else version
    if not version:
        raise FileNotFoundError(f"no version was ever committed to {base}")
    return StructType.fromJson(_marker(spark, base, version)["schema"])


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``path`` with its whole content unless it is there; of two writers one gets true.

    The content is written beside it first.  Then a link is made on a local disk,
    elsewhere the file is renamed without overwriting, which a shared file system does in one step.
    """
    jvm, target, fs = _fs(spark, path)
    fs.mkdirs(target.getParent())
    _, staged, _ = _fs(spark, f"{target.getParent()}/staged-{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(target), local(staged))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(staged, target, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception:
        if fs.exists(target):
            return False
        raise
    finally:
        fs.delete(staged, False)
    return True


def _commit(spark: SparkSession, base: str, rows: DataFrame, version: int, schema: StructType) -> int:
    """Write a manifest and create the version's marker, which names it; a writer that comes second fails."""
    folder = f"manifests/{uuid.uuid4().hex}"
    rows.write.parquet(f"{base}/{folder}")
    if not _create_once(spark, f"{base}/versions/v{version:012d}", json.dumps({"manifest": folder, "schema": schema.jsonValue()})):
        raise Conflict(f"version {version} was committed by another writer")
    return version


def _free_name(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _described(spark: SparkSession, folder: str, version: int, small: int, fanout: int) -> DataFrame:
    """Manifest rows of the shards in a folder just written."""
    sizes = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("shard"), F.col("_metadata.file_size").alias("n_bytes"))
    rows = sizes.groupBy("shard", "n_bytes").agg(F.count("*").alias("n_rows"))
    tier = F.greatest(F.lit(0), F.floor(F.log(F.col("n_bytes") / F.lit(small)) / F.log(F.lit(fanout)))).cast("int")
    return rows.select("shard", "n_rows", "n_bytes", tier.alias("tier"), F.lit(version).cast("long").alias("version"))


def append(rows: DataFrame, base: str, shard_rows: int = 2000, small: int = 1 << 20, fanout: int = 4, attempts: int = 20) -> int:
    """Add ``rows`` as shards of at most ``shard_rows`` rows, without a shuffle; the new version.

    No rows make a version without new shards, which keeps the schema.  The rows
    are written once; if another writer commits in between, only the manifest is
    made anew, up to ``attempts`` times.  Columns must be those of the store.
    """
    spark = rows.sparkSession
    folder = f"{base}/shards/{uuid.uuid4().hex}"
    version = current_version(spark, base)
    if version and schema_of(spark, base, version).simpleString() != rows.schema.simpleString():
        raise ValueError("the columns differ from those of the store")
    rows.write.option("compression", "zstd").option("maxRecordsPerFile", shard_rows).parquet(folder)
    for left in range(attempts, 0, -1):
        version = current_version(spark, base)
        try:
            new = _described(spark, folder, version + 1, small, fanout)
            return _commit(spark, base, manifest(spark, base, version).unionByName(new), version + 1, rows.schema)
        except Conflict:
            if left == 1:
                raise
    return version


def merge_plan(shards: DataFrame, target: int, fanout: int, lot: int = 10_000, most: int = 50_000) -> DataFrame:
    """``shard, run``: which shards to rewrite together.

    Shards of half the target or more are done.  The others of a tier are taken
    in order of size until the target is reached; a run of fewer than ``fanout``
    shards waits unless it fills the target.  A run has at most ``most`` shards.
    Tiers are planned in lots of about ``lot`` shards, so no task plans an unbounded tier.
    """
    open_ = shards.where(F.col("n_bytes") < target / 2)
    lots = open_.groupBy("tier").agg(F.ceil(F.count("*") / lot).alias("lots"))
    dealt = open_.join(F.broadcast(lots), "tier").withColumn("lot", F.pmod(F.xxhash64("shard"), F.col("lots")))  # a tier is a power of the fan-out, so there are few
    before = Window.partitionBy("tier", "lot").orderBy("n_bytes", "shard").rowsBetween(Window.unboundedPreceding, -1)
    size, nth = F.coalesce(F.sum("n_bytes").over(before), F.lit(0)), F.count("*").over(before)
    placed = dealt.withColumn("step", F.concat_ws(".", F.floor(size / target), F.floor(nth / most)))
    group = Window.partitionBy("tier", "lot", "step")
    placed = placed.withColumn("members", F.count("*").over(group)).withColumn("total", F.sum("n_bytes").over(group))
    run = F.concat_ws("-", "tier", "lot", "step")
    return placed.where((F.col("members") > 1) & ((F.col("members") >= fanout) | (F.col("total") >= target))).select("shard", run.alias("run"))


def next_runs(shards: DataFrame, target: int, fanout: int, most: int) -> list[tuple[str, str]]:
    """``(shard, run)`` of as many whole runs as have ``most`` shards together at most, one run at least if there is any.

    A run has two shards or more and ``most`` at most, so neither list that comes to the driver is longer than ``most``.
    """
    plan = merge_plan(shards, target, fanout, most=most)
    names: list[str] = []
    total = 0
    for r in plan.groupBy("run").agg(F.count("*").alias("n")).orderBy("run").limit(max(1, most // 2)).collect():
        if names and total + r.n > most:
            break
        names.append(r.run)
        total += r.n
    if not names:
        return []
    chosen = shards.sparkSession.createDataFrame([(n,) for n in names], "run string")
    return [(r.shard, r.run) for r in plan.join(F.broadcast(chosen), "run").select("shard", "run").collect()]


def compact(spark: SparkSession, base: str, target: int = 64 << 20, small: int = 1 << 20, fanout: int = 4, most: int = 50_000) -> int:
    """Merge until no tier has a run left to merge; the version reached.

    Each round rewrites at most ``most`` shards and commits, so the list that is
    broadcast with the rows stays small; the next round goes on from there.  A
    round that another writer overtakes is planned again; the shards it wrote are
    named by no version, and :func:`vacuum` takes them away.
    """
    most = max(fanout, most)  # a run needs so many
    while True:
        version = current_version(spark, base)
        if not version:
            return version
        live, schema = manifest(spark, base, version), schema_of(spark, base, version)
        picked = next_runs(live, target, fanout, most)
        if not picked:
            return version
        folder = f"{base}/shards/{uuid.uuid4().hex}"
        number = {run: k for k, run in enumerate(sorted({r for _, r in picked}))}
        shard, run = _free_name(schema.names, "shard__"), _free_name(schema.names, "run__")
        plan = spark.createDataFrame([(s, number[r]) for s, r in picked], f"`{shard}` string, `{run}` int")
        rows = spark.read.schema(schema).parquet(*[s for s, _ in picked])
        rows = rows.withColumn(shard, F.col("_metadata.file_path")).join(F.broadcast(plan), shard).drop(shard)
        # One task for each run, which is about one target file.
        rows.repartitionById(len(number), F.col(run)).write.option("compression", "zstd").partitionBy(run).parquet(folder)
        kept = live.join(plan.select(F.col(shard).alias("shard")), "shard", "left_anti")
        try:
            _commit(spark, base, kept.unionByName(_described(spark, folder, version + 1, small, fanout)), version + 1, schema)
        except Conflict:
            continue


def read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default.  Paths come to the driver, where Spark's reader lists every file anyway."""
    schema = schema_of(spark, base, version)
    shards = [r.shard for r in manifest(spark, base, version).select("shard").collect()]
    return spark.read.schema(schema).parquet(*shards) if shards else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, base: str, lot: int = 10_000) -> int:
    """Delete shards that the newest version doesn't name, in lots of ``lot`` files; how many.  Run it while nobody writes."""
    _, at, fs = _fs(spark, f"{base}/shards")
    # Spark and Hadoop spell a path's start differently; what follows the folder is the same.
    live = manifest(spark, base).select(F.substring_index("shard", "/shards/", -1).alias("shard"))
    files, gone = fs.listFiles(at, True), 0
    while files.hasNext():
        paths = []
        while files.hasNext() and len(paths) < lot:
            path = files.next().getPath()
            if path.getName().endswith(".parquet"):
                paths.append(path)
        named = spark.createDataFrame([(k, p.toString().rsplit("/shards/", 1)[1]) for k, p in enumerate(paths)], "k int, shard string")
        for r in named.join(live, "shard", "left_anti").collect():
            gone += fs.delete(paths[r.k], False)
    return gone
