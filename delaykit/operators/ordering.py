"""Ordering, numbering and top-k.

Global positions are computed without a single-partition window: a range
sort spreads the rows over many tasks; the sorted rows are written once, with
their partition id and in-partition id as columns, to the shared
``spark.checkpoint.dir`` (cutting lineage, so a lost executor re-reads instead
of re-sorting with different range bounds); each row's index is
``offset(partition) + position in partition``.  The offsets
table has one row per partition, a proven bound, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.session import materialize


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (O1, O3): ``TakeOrderedAndProject``, a per-task
    top-n merged on one task, never a full sort.  Callers add a full tie-break."""
    return df.orderBy(*order).limit(n)


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_index") -> DataFrame:
    """Add a 0-based contiguous position in ``order`` (a distributed ``zipWithIndex``).

    The range-sorted rows are written once with their partition id and
    in-partition id as columns, so offsets computed later cannot disagree with
    the rows they are applied to.
    """
    ordered = (df.orderBy(*order)
                 .withColumn("__pid", F.spark_partition_id())
                 .withColumn("__mid", F.monotonically_increasing_id()))
    tagged = materialize(ordered, "row-index")
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
                  .withColumn(name, F.col("__mid") - F.col("__first") + F.col("__off"))
                  .drop("__pid", "__mid", "__first", "__off"))


def contiguous_folds(df: DataFrame, order: Sequence[Column | str], k: int = 3,
                     name: str = "fold") -> DataFrame:
    """Unshuffled K-fold assignment over a stable order (M3).

    Fold sizes follow ``ntile``: the first ``n % k`` folds hold one row more.
    """
    indexed = row_index(df, order, "__rn")
    n = indexed.select(F.count(F.lit(1))).scalar()
    q = F.floor(n / F.lit(k))
    r = n - q * F.lit(k)
    big = r * (q + 1)
    rn = F.col("__rn")
    fold = F.when(rn < big, F.floor(rn / (q + 1))).otherwise(r + F.floor((rn - big) / q))
    return indexed.withColumn(name, fold.cast("int")).drop("__rn")


def hash_folds(df: DataFrame, key_cols: Sequence[str], k: int = 3, name: str = "fold") -> DataFrame:
    """Scalable shuffled folds: a hash of the key, no ordering needed."""
    return df.withColumn(name, F.pmod(F.xxhash64(*key_cols), F.lit(k)).cast("int"))


def running_count(df: DataFrame, partition_cols: Sequence[str], pos_col: str, flag: Column,
                  name: str = "flags_before", block: int = 65536) -> DataFrame:
    """Number of earlier rows (smaller ``pos``) in the same partition with ``flag`` true.

    Two-level prefix sum so that no window ever holds a whole hot partition:
    per-block flag counts are a partial aggregate; the prefix over blocks
    sees one row per block; the prefix inside a block sees at most ``block``
    rows.  ``pos`` must be an integer position, unique inside a partition.
    """
    blk = F.floor(F.col(pos_col) / F.lit(block)).cast("long")
    flagged = df.withColumn("__blk", blk).withColumn("__f", F.when(flag, 1).otherwise(0))
    blocks = flagged.groupBy(*partition_cols, "__blk").agg(F.sum("__f").alias("__nb"))
    prior_blocks = Window.partitionBy(*partition_cols).orderBy("__blk").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.select(*partition_cols, "__blk",
                           F.coalesce(F.sum("__nb").over(prior_blocks), F.lit(0)).alias("__pre"))
    prior_rows = Window.partitionBy(*partition_cols, "__blk").orderBy(pos_col).rowsBetween(
        Window.unboundedPreceding, -1)
    inner = flagged.withColumn("__in", F.coalesce(F.sum("__f").over(prior_rows), F.lit(0)))
    return (inner.join(blocks, [*partition_cols, "__blk"])
                 .withColumn(name, (F.col("__pre") + F.col("__in")).cast("long"))
                 .drop("__blk", "__f", "__pre", "__in"))


def number_within(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column | str],
                  name: str = "rn") -> DataFrame:
    """1-based position inside each partition key, whatever a key's size.

    A range sort on (key, order) cuts a large key over many tasks; the sorted rows are written once (see
    ``row_index``), and a row's number is its place among its key's rows of that task plus the key's rows in
    the tasks before.  Only the table of (key, task) counts is windowed.  Keys must not be NULL.
    """
    tagged = materialize(df.orderBy(*partition_cols, *order)
                           .withColumn("__pid", F.spark_partition_id())
                           .withColumn("__mid", F.monotonically_increasing_id()), "numbered")
    sizes = tagged.groupBy(*partition_cols, "__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.partitionBy(*partition_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*partition_cols, "__pid", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (tagged.join(offsets, [*partition_cols, "__pid"])
                  .withColumn(name, F.col("__mid") - F.col("__first") + F.col("__off") + 1)
                  .select(*df.columns, name))
