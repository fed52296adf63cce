"""Distinct / duplicate handling and unions.

Duplicate detection is a grouped count (partial aggregation, so a hot key
is reduced in every task) joined back with a null-safe semi join; AQE splits
a skewed join partition.  No window over a whole key is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.operators.joins import null_safe_condition
from delaykit.operators.ordering import top_n


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.dropDuplicates()


def _keys_with_count(df: DataFrame, keys: Sequence[str], keep) -> DataFrame:
    aliased = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    counts = df.groupBy(*aliased).agg(F.count(F.lit(1)).alias("__n"))
    return counts.filter(keep(F.col("__n"))).drop("__n")


def _semi(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    right = [f"__k{i}" for i in range(len(keys))]
    return df.join(keys_df, null_safe_condition(df, keys_df, keys, right), "left_semi")


def keep_unique_keys(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop every row of a duplicated key, keep none of them (D2, ``keep=False``).

    One grouped pass: a key's row is carried beside its count, so there is one scan, one shuffle and no join."""
    keys = list(keys or df.columns)
    rest = [c for c in df.columns if c not in keys]
    carried = [F.any_value(F.struct(*rest)).alias("__row")] if rest else []
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *carried).filter(F.col("__n") == 1)
    return groups.select(*[F.col(f"__row.`{c}`").alias(c) if c in rest else F.col(c) for c in df.columns])


def duplicate_members(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Every row whose key (default: the whole row) occurs more than once."""
    keys = list(keys or df.columns)
    return _semi(df, _keys_with_count(df, keys, lambda n: n > 1), keys)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each whole-row group: ``count - count distinct``.

    One grouped count (partial aggregation map-side) summed as ``n - 1`` per group.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def list_duplicates(df: DataFrame, order: Sequence[Column | str], n: int = 12) -> DataFrame:
    """First ``n`` members of duplicated rows in ``order`` (D3)."""
    return top_n(duplicate_members(df), order, n)


def union_pages(*dfs: DataFrame) -> DataFrame:
    """Concatenate same-shaped batches, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_ragged(*dfs: DataFrame) -> DataFrame:
    """Union of key sets: a column absent from a batch is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
