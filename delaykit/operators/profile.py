"""Profiling aggregates.

Every statistic is an aggregate with map-side partial aggregation; quantiles
are computed on a value -> count table first so the single final merge holds
one entry per distinct value, not per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.operators.filters import within


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count per non-NULL value, most frequent first (A1)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column))


def null_count(df: DataFrame, column: str) -> DataFrame:
    """NULL count of one column (A2)."""
    return df.agg(F.count_if(F.col(column).isNull()).cast("long").alias("n_null"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count of every column, one pass, as (column, n_null) most first (A3)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column", "n_null")
    return long.orderBy(F.desc("n_null"), "column")


def frame_info(df: DataFrame) -> DataFrame:
    """(column, position, non_null, dtype) per column in one pass (A4)."""
    agg = df.agg(*[F.count(F.col(c)).cast("long").alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column", "non_null")
    meta = df.sparkSession.createDataFrame(
        [(c, i, t) for i, (c, t) in enumerate(df.dtypes)], "column string, position int, dtype string")
    # ``meta`` has one row per column of the schema: a plan-time constant.
    return long.join(F.broadcast(meta), "column").select("column", "position", "non_null", "dtype")


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) (A5)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_cols"))


def quantiles(df: DataFrame, column: str, probs: Sequence[float] = (0.25, 0.75),
              method: str = "distributed", buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics (A8),
    one row with columns ``q25``, ``q75``, ... (pandas' default definition).

    ``method="distributed"`` (default): right whatever the number of distinct
    values; no task ever holds more than one range bucket (see
    ``_distributed_quantiles``).
    ``method="merge"``: rows are reduced to (value, count) by a partial
    aggregate, then one frequency-weighted ``percentile`` merges the distinct
    values in a single task — only for columns with a bounded distinct count.
    ``method="approx"``: ``percentile_approx`` (opt-in, not exact).
    ``buckets`` defaults to ``spark.sql.shuffle.partitions``: a bucket is then
    one shuffle partition's worth of distinct values, the unit the cluster is
    already sized for.
    """
    names = [f"q{int(round(p * 100))}" for p in probs]
    col = F.col(column)
    clean = df.filter(col.isNotNull() & ~F.isnan(col))
    if method == "approx":
        arr = F.percentile_approx(col, F.array(*[F.lit(p) for p in probs]), 10000)
        return clean.agg(arr.alias("__q")).select(*[F.col("__q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    counts = clean.groupBy(col.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    if method == "distributed":
        if buckets is None:
            buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return _distributed_quantiles(counts, probs, names, buckets)
    if method != "merge":
        raise ValueError("method must be 'merge', 'distributed' or 'approx'")
    arr = F.percentile(F.col("__v"), F.array(*[F.lit(p) for p in probs]), F.col("__n"))
    return counts.agg(arr.alias("__q")).select(*[F.col("__q")[i].alias(n) for i, n in enumerate(names)])


def _distributed_quantiles(counts: DataFrame, probs: Sequence[float], names: Sequence[str],
                           buckets: int) -> DataFrame:
    """Exact order statistics without a single-task merge.

    1. The (value, count) table is range-partitioned into ``buckets`` sorted
       ranges; the bucket id is stored as a column and the table written once
       to the shared checkpoint folder, so every later step sees the same buckets.
    2. Per-bucket row totals (one row per bucket) give each bucket's first rank.
    3. Only the buckets containing a wanted rank (at most 2 per quantile: a
       proven bound, so broadcast) are scanned with a cumulative count to pick
       the exact values; the result is interpolated as pandas does.
    """
    from pyspark.sql import Window

    from delaykit.session import materialize

    ranged = materialize(counts.repartitionByRange(buckets, "__v").withColumn("__pid", F.spark_partition_id()),
                         "quantile-buckets")
    per_bucket = ranged.groupBy("__pid").agg(F.sum("__n").alias("__cnt"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("__start", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
    n = per_bucket.select(F.sum("__cnt")).scalar()
    slots = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (n - 1)
        slots.append(F.struct(F.lit(2 * i).alias("slot"), F.floor(pos).alias("r")))
        slots.append(F.struct(F.lit(2 * i + 1).alias("slot"), F.ceil(pos).alias("r")))
    # (bucket, slot) pairs: buckets x 2 x len(probs) rows, then keep the bucket holding each rank.
    targets = (per_bucket.withColumn("__slots", F.array(*slots))
                         .select("__pid", "__start", "__cnt", F.explode("__slots").alias("t"))
                         .filter((F.col("t.r") >= F.col("__start")) & (F.col("t.r") < F.col("__start") + F.col("__cnt")))
                         .select("__pid", F.col("t.slot").alias("__slot"), (F.col("t.r") - F.col("__start")).alias("__local")))
    picked = ranged.join(F.broadcast(targets), "__pid")
    upto = Window.partitionBy("__pid", "__slot").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    picked = picked.withColumn("__cum", F.sum("__n").over(upto)).filter(
        (F.col("__cum") - F.col("__n") <= F.col("__local")) & (F.col("__local") < F.col("__cum")))
    values = picked.agg(*[F.max(F.when(F.col("__slot") == j, F.col("__v"))).alias(f"__s{j}")
                          for j in range(2 * len(probs))])
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos = F.lit(float(p)) * (n - 1)
        lo, hi = F.col(f"__s{2 * i}"), F.col(f"__s{2 * i + 1}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).cast("double").alias(name))
    return values.select(*out)


def iqr_bounds(df: DataFrame, column: str, whisker: float = 1.5, method: str = "distributed") -> DataFrame:
    """One row (q1, q3, lower, upper) with ``Q1 - 1.5 IQR``, ``Q3 + 1.5 IQR`` (A9); ``method`` as in ``quantiles``."""
    q = quantiles(df, column, (0.25, 0.75), method)
    iqr = F.col("q75") - F.col("q25")
    return q.select(F.col("q25").alias("q1"), F.col("q75").alias("q3"),
                    (F.col("q25") - whisker * iqr).alias("lower"),
                    (F.col("q75") + whisker * iqr).alias("upper"))


def iqr_filter(df: DataFrame, column: str, whisker: float = 1.5, method: str = "distributed") -> DataFrame:
    """Rows inside the inclusive IQR fences (A9 + P6).

    The fences are one scalar subquery: evaluated once, then a plain filter;
    no join and no cartesian product.
    """
    # One array-valued scalar subquery; both references are the same subquery,
    # evaluated once (checked by job count: one fence or two costs the same).
    # The subquery and the filter each read ``df``: when ``df`` is an expensive
    # plan (a join), materialise it first so that work happens once.
    fences = iqr_bounds(df, column, whisker, method).select(F.array("lower", "upper")).scalar()
    return df.filter(within(F.col(column), fences[0], fences[1]))


_DAY_MICROS_TO_2359 = (23 * 60 + 59) * 60_000_000  # [00:00, 23:59] as in the reference plot range


def day_histogram(df: DataFrame, columns: Sequence[str], bins: int = 24, day=None,
                  mode: str = "range") -> DataFrame:
    """Counts per (day, series, bin) for time columns (A10).

    ``mode="range"`` reproduces equal-width bins over ``[00:00, 23:59]`` of the
    day (59.96-minute bins, last bin closed, times after 23:59 dropped);
    ``mode="clock"`` uses clock hours.  Rows need every column non-NULL.
    With ``day=None`` every day present is histogrammed (grouped by day);
    ``day="first"`` takes the day of the earliest value of the first column
    (the reference takes the day of its first row, which a distributed table
    does not have); otherwise only the given day.  Zero bins are filled from a
    generated grid.
    """
    rows = df.select(*columns).dropna(how="any")
    stacked = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("series"), F.col(c).cast("timestamp_ntz").alias("t")) for c in columns
    ])).alias("s")).select("s.series", "s.t")
    stacked = stacked.withColumn("day", F.to_date("t"))
    if day == "first":
        first_day = rows.select(F.min(F.to_date(F.col(columns[0])))).scalar()
        stacked = stacked.filter(F.col("day") == first_day)
    elif day is not None:
        stacked = stacked.filter(F.col("day") == F.to_date(F.lit(day)))
    micros = F.timestamp_diff("MICROSECOND", F.col("day").cast("timestamp_ntz"), F.col("t"))
    if mode == "range":
        width_total = _DAY_MICROS_TO_2359
        raw = F.floor(micros * F.lit(bins) / F.lit(width_total)).cast("int")
        # Times after 23:59 fall outside the plotted range: bin -1, dropped after the grid join.
        binned = stacked.withColumn("bin", F.when(micros <= F.lit(width_total), F.least(raw, F.lit(bins - 1)))
                                             .otherwise(F.lit(-1)))
    elif mode == "clock":
        binned = stacked.withColumn("bin", F.hour("t"))
        bins = 24
    else:
        raise ValueError("mode must be 'range' or 'clock'")
    counts = binned.groupBy("day", "series", "bin").agg(F.count(F.lit(1)).alias("count"))
    # Grid of every (day, series, bin): days come from the (small) counts table,
    # series and bins are constants, so the data is scanned once.
    days = counts.select("day").distinct()
    grid = days.select("day", F.explode(F.array(*[F.lit(c) for c in columns])).alias("series")) \
               .select("day", "series", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts.filter(F.col("bin") >= 0), ["day", "series", "bin"], "left")
                .select("day", "series", "bin", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def clock_hour_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per clock hour of ``column`` (A10, ``bins="clock"``)."""
    return (df.filter(F.col(column).isNotNull())
              .groupBy(F.date_trunc("hour", F.col(column)).alias("hour"))
              .agg(F.count(F.lit(1)).cast("long").alias("count")))


def range_checksum(pages: DataFrame, endpoint: Column, n_items: Column, declared: Column) -> DataFrame:
    """Per endpoint: items received vs the declared total (A11), every endpoint checked."""
    return (pages.groupBy(endpoint.alias("endpoint"))
                 .agg(F.sum(n_items).cast("long").alias("n_received"),
                      F.max(declared).cast("long").alias("n_declared"))
                 .withColumn("matches", F.col("n_received") == F.col("n_declared")))


def argmax(df: DataFrame, group_cols: Sequence[str], name_col: str, score_col: str,
           tie_cols: Sequence[str] = ()) -> DataFrame:
    """Per group the name with the highest score.

    Ties go to the smallest ``tie_cols`` (default: the name).  A ``min_by``
    aggregate over the key (-score, tie...), reduced map-side; NULL scores
    never win.
    """
    tie = list(tie_cols) or [name_col]
    key = F.struct((-F.col(score_col)).alias("__s"), *[F.col(c) for c in tie])
    best = F.min_by(F.struct(F.col(name_col), F.col(score_col)), key)
    out = df.filter(F.col(score_col).isNotNull()).groupBy(*group_cols).agg(best.alias("__b"))
    return out.select(*group_cols, F.col(f"__b.{name_col}").alias(name_col),
                      F.col(f"__b.{score_col}").alias(score_col))


def last_per_key(df: DataFrame, key_cols: Sequence[str], order_col: str,
                 value_cols: Sequence[str]) -> DataFrame:
    """The latest row per key by ``order_col`` (A14): later overwrites earlier."""
    payload = F.struct(*[F.col(c) for c in value_cols], F.col(order_col))
    return (df.groupBy(*key_cols).agg(F.max_by(payload, F.col(order_col)).alias("__l"))
              .select(*key_cols, *[F.col(f"__l.{c}").alias(c) for c in [*value_cols, order_col]]))


def neg_mse(label: Column, prediction: Column) -> Column:
    """Negative mean squared error (A16), an aggregate expression."""
    return -F.avg(F.pow(label - prediction, 2))
