"""Declared table constraints re-aimed as data checks that return the
violating rows (Q1-Q5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any declared NOT NULL column (Q1)."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (Q2)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).cast("long").alias("n"))
              .filter(F.col("n") > 1))


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (Q3); NULL keys are exempt."""
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    return (child.filter(F.col(fk).isNotNull())
                 .join(keys, F.col(fk) == F.col("__pk"), "left_anti"))


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows whose text is longer than its declared width (Q4)."""
    cond = F.lit(False)
    for c, n in limits.items():
        cond = cond | (F.length(F.col(c)) > n)
    return df.filter(cond)


def daily_rollup(df: DataFrame, time_col: str, group_cols: Sequence[str], value_col: str,
                 category_col: str | None = None) -> DataFrame:
    """Per (day, group): max, min, sum of a measure and the dominant category (Q5).

    The dominant category is the most frequent one, ties to the smallest
    value: counts per category first (partial aggregate), then ``min_by``.
    """
    day = F.to_date(F.col(time_col)).alias("day")
    base = df.select(day, *group_cols, value_col, *( [category_col] if category_col else []))
    keys = ["day", *group_cols]
    stats = base.groupBy(*keys).agg(
        F.max(value_col).alias(f"max_{value_col}"),
        F.min(value_col).alias(f"min_{value_col}"),
        F.sum(value_col).alias(f"sum_{value_col}"),
        F.count(F.lit(1)).cast("long").alias("n"))
    if category_col is None:
        return stats
    per_cat = base.filter(F.col(category_col).isNotNull()).groupBy(*keys, category_col).agg(
        F.count(F.lit(1)).alias("__c"))
    dominant = per_cat.groupBy(*keys).agg(
        F.min_by(F.col(category_col), F.struct(-F.col("__c"), F.col(category_col))).alias(f"dominant_{category_col}"))
    return stats.join(dominant, keys, "left")
