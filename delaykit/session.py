"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import contextlib
import math
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every delaykit job relies on.  AQE re-plans joins from real shuffle
# sizes (broadcast when a side turns out small, split skewed partitions when one
# key holds a large share of the rows) and coalesces tiny partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "delaykit",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with delaykit's defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent on a local master (a laptop or a test) do we make our own
    folder.  A cluster without the setting is an error: a folder of this machine would be
    invisible to its executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[(\*|\d+)(,\s*\d+)?\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir isn't set; master {master} needs a folder that all executors share")
        path = tempfile.mkdtemp(prefix="delaykit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def workers_find_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package also when the session runs from another folder (a cluster gets it
    by ``--py-files`` or an installed wheel)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def materialize(df, name: str = "stage", compression: str = "snappy", buckets: tuple[str, int] | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    recomputing, possibly differently, e.g. new range bounds) with a single
    computation of ``df``; an eager ``checkpoint()`` would compute it twice.
    Anything that depends on the physical layout must be stored as columns
    before calling this (e.g. ``spark_partition_id()``).  ``buckets``, a column and a number, deals the rows into that many
    buckets by the column: later groupings by it read them where they are, without a shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"delaykit-{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("errorifexists").option("compression", compression)
    with _shuffles_deleted(spark):
        if buckets:  # only tables of the catalog have buckets
            writer.bucketBy(buckets[1], buckets[0]).format("parquet").option("path", path).saveAsTable(_bucketed(path))
        else:
            writer.parquet(path)
    for scope in _SCOPES:
        scope.append(path)
    return spark.table(_bucketed(path)) if buckets else spark.read.parquet(path)


def _bucketed(path: str) -> str:
    return "spark_catalog.default." + os.path.basename(path).replace("-", "_")


def _delete(spark: SparkSession, path: str) -> None:
    """Deletes a table that ``materialize`` wrote, from the catalog too if it is bucketed."""
    spark.sql(f"DROP TABLE IF EXISTS {_bucketed(path)}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(df) -> None:
    """Deletes the table that ``materialize`` wrote for ``df``; for steps of a loop that nothing reads again."""
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        if os.path.basename(path).startswith("delaykit-"):
            _delete(df.sparkSession, path)


# Spark's setting to delete the shuffle files of a query that has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_deleted(spark: SparkSession):
    """The shuffle files of what runs inside are deleted when it ends, not when the driver happens to collect garbage: a
    chain of written stages holds the disk of one stage at a time.  While a stage runs, its shuffles are kept, so a lost
    executor's are computed again from the tables written before."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_tables(spark: SparkSession):
    """Tables that ``materialize`` writes inside the block are deleted when it ends.

    For jobs whose outputs are written before they return; a query that hands back a lazy
    DataFrame over such tables must not use it.
    """
    mine: list[str] = []
    _SCOPES.append(mine)
    try:
        yield
    finally:
        _SCOPES.remove(mine)
        for path in mine:
            _delete(spark, path)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path``, from a distributed listing
    (``binaryFile`` without reading contents)."""
    from pyspark.sql import functions as F

    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return int(listing.select(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def size_shuffle_partitions(spark: SparkSession, shuffle_bytes: int, target_bytes: int = 256 * 1024 ** 2,
                            minimum: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` so a reducer receives about
    ``target_bytes`` of the expected shuffle volume.

    AQE coalesces partitions that turn out small but never splits large ones
    (skew handling aside), so the initial number must be sized for the
    largest shuffle: at 100 TB of input with a third of it shuffled, 256 MB
    reducers give ~130,000 partitions.
    """
    minimum = minimum or 2 * spark.sparkContext.defaultParallelism
    n = int(max(minimum, math.ceil(shuffle_bytes / target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
