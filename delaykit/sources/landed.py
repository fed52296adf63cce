"""Landed API calls (S16): which pages of a day's 4-hour ranges are kept.

Each call record carries (day, range, call order, status).  Rules:
pages with status 200 are data; within a range the *last* call's status
decides — a 404 there means the range yields nothing (faithful mode; the
default keeps the range's 200 pages); any status other than 200/404 ends the
day, so that range and every later range of the day yield nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kept_pages(calls: DataFrame, day_col: str, range_col: str, order_col: str, status_col: str,
               faithful_404: bool = False, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Filter call records to the pages the day download keeps."""
    keys = [*extra_keys, day_col]
    ranges = calls.groupBy(*keys, range_col).agg(
        F.max_by(F.col(status_col), F.col(order_col)).alias("last_status"))
    stops = (ranges.filter(~F.col("last_status").isin(200, 404))
                   .groupBy(*keys).agg(F.min(range_col).alias("__stop_range")))
    out = (calls.filter(F.col(status_col) == 200)
                .join(ranges, [*keys, range_col])
                .join(stops, keys, "left")
                .filter(F.col("__stop_range").isNull() | (F.col(range_col) < F.col("__stop_range"))))
    if faithful_404:
        out = out.filter(F.col("last_status") == 200)
    else:
        out = out.filter(F.col("last_status").isin(200, 404))
    return out.drop("__stop_range")


def success_counts(calls: DataFrame, group_cols: Sequence[str], status_col: str) -> DataFrame:
    """Calls and successful (200) calls per group."""
    return calls.groupBy(*group_cols).agg(
        F.count(F.lit(1)).cast("long").alias("n_calls"),
        F.count_if(F.col(status_col) == 200).cast("long").alias("n_success"))
