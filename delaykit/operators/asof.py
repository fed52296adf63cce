"""As-of joins: the latest row not after a time (J4 by the hour).

Both sides are united and range-sorted by (key, time), so a key that holds a third of the rows is cut over many tasks; the
sorted rows are written once with the task that sorted them.  Inside a task the last partner seen is carried forward; what
a key's earlier tasks end with comes from a table of one row per (key, task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.session import materialize


def asof_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], left_time: str,
              right_time: str, right_cols: Sequence[str], within: Column | None = None) -> DataFrame:
    """Every row of ``left`` once, with ``right_cols`` of the row of ``right`` that has the same keys and the latest
    ``right_time`` not after ``left_time``; NULLs where there is none, where a key or time is NULL, or where that row is
    older than the interval ``within``.  Of rows of one key and time the largest by ``right_cols`` counts."""
    keys = [f"__k{i}" for i in range(len(left_keys))]
    given = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__row"),
                        *[F.col(k).alias(n) for k, n in zip(left_keys, keys)], F.col(left_time).alias("__t"))
    partner = F.struct(F.col(right_time).alias("__at"), *[F.col(c) for c in right_cols])
    offered = right.select(partner.alias("__offer"), *[F.col(k).alias(n) for k, n in zip(right_keys, keys)],
                           F.col(right_time).alias("__t")).dropna(subset=[*keys, "__t"])
    both = given.withColumn("__side", F.lit(1)).unionByName(offered.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    placed = both.orderBy(*keys, "__t", "__side", "__offer")
    tagged = materialize(placed.withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id()), "asof")
    # A window never holds more than one task's rows of a key.
    inside = Window.partitionBy("__pid", *keys).orderBy("__mid").rowsBetween(Window.unboundedPreceding, 0)
    carried = tagged.withColumn("__last", F.last("__offer", ignorenulls=True).over(inside)).filter("__side = 1")
    ends = tagged.filter("__side = 0").groupBy(*keys, "__pid").agg(F.max_by("__offer", "__mid").alias("__end"))
    # Tasks of a key, each with what the tasks before it end with: one row per (key, task).
    met = tagged.select(*keys, "__pid").distinct().join(ends, [*keys, "__pid"], "left")
    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    before = met.withColumn("__before", F.last("__end", ignorenulls=True).over(earlier)).filter("__before IS NOT NULL").select(
        *keys, "__pid", "__before")
    known = F.lit(True)
    for k in [*keys, "__t"]:
        known = known & F.col(k).isNotNull()
    best = F.coalesce("__last", "__before")
    fresh = known if within is None else known & (best["__at"] >= F.col("__t") - within)
    found = carried.join(before, [*keys, "__pid"], "left").withColumn("__best", F.when(fresh, best))
    return found.select("__row.*", *[F.col("__best")[c].alias(c) for c in right_cols])
