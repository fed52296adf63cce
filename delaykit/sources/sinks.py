"""Sinks and table maintenance.

A target is a catalog table name (``db.table``) or a storage path (Parquet).
Writes are distributed (one file per task); nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from delaykit.operators.incremental import new_rows_only
from delaykit.session import materialize


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str]):
    writer = df.write.mode(mode)
    if partition_by:
        # Only the partitions that the rows fall into are replaced.
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    return writer


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """JSON lines, overwriting (S7); with ``partition_by`` only the partitions written to."""
    _writer(df, mode, partition_by).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Header CSV without an index column, overwriting (S8); with ``partition_by`` only the partitions written to."""
    _writer(df, mode, partition_by).option("header", True).csv(path)


def quarantine(bad: DataFrame, target: str) -> int:
    """Append files and pages that lost something (``sources.files.unreadable``, ``unreadable_pages``) to the quarantine
    table and return the number added; a clean landing writes nothing.  What the table lists already isn't added again, so
    a run or micro-batch that is repeated leaves one entry."""
    spark = bad.sparkSession
    bad = bad.dropDuplicates(["file_path", "reason"])
    if table_exists(spark, target):
        bad = bad.join(read_target(spark, target).select("file_path", "reason"), ["file_path", "reason"], "left_anti").select(*bad.columns)
    bad = materialize(bad, "quarantine")
    n = bad.count()
    if n:
        append_rows(bad, target)
    return n


def table_exists(spark: SparkSession, target: str) -> bool:
    if _is_path(target):
        try:
            spark.read.parquet(target).schema  # noqa: B018 - listing only, no data read
            return True
        except AnalysisException:
            return False
    return spark.catalog.tableExists(target)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def _write(df: DataFrame, target: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def append_rows(df: DataFrame, target: str) -> None:
    """Plain append of every row (S9, ``insert_existing_rows=True``)."""
    _write(df, target, "append")


def append_new_rows(spark: SparkSession, df: DataFrame, target: str) -> DataFrame:
    """Append only rows absent from the target (S10 = J3 + append); creates the
    target when missing.  Returns the appended rows (lazily re-readable)."""
    if not table_exists(spark, target):
        _write(df, target, "errorifexists")
        return df
    existing = read_target(spark, target)
    fresh = new_rows_only(df, existing)
    # Cut the lineage to the target before writing into it: the rows to add are
    # materialised in the shared checkpoint folder, so the append never reads
    # files it is writing.
    fresh = materialize(fresh, "append")
    _write(fresh, target, "append")
    return fresh


def replace_table(df: DataFrame, target: str) -> None:
    """Drop and rewrite, schema included."""
    _write(df, target, "overwrite")


def create_table(df: DataFrame, target: str) -> None:
    """Create; an error when it exists."""
    _write(df, target, "errorifexists")


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create the database when missing, else nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def column_as_table(df: DataFrame, col: str | Column, name: str = "target") -> DataFrame:
    """A single series stored as a one-column table with a real name."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(name))
