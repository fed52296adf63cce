"""Projections and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.functions.timefmt import parse_minute_text


def select_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Column subset in the given order; a missing column is an error."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*columns)


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """``column == value`` (P3); pushed to the Parquet scan by Catalyst."""
    return df.filter(F.col(column) == F.lit(value))


def drop_incomplete(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL in any column of ``subset``.

    NaN in a double column counts as missing too, as the frame library treats it.
    """
    cond = F.lit(True)
    types = dict(df.dtypes)
    for c in subset:
        col = F.col(c)
        ok = col.isNotNull()
        if types.get(c) in ("double", "float"):
            ok = ok & ~F.isnan(col)
        cond = cond & ok
    return df.filter(cond)


def where_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def where_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def within(col: Column, lo: Column, hi: Column) -> Column:
    """Inclusive two-sided range predicate."""
    return (col >= lo) & (col <= hi)


# The flight time column names, 2 moments x 3 kinds x 2 zones.
TIME_COLUMNS = [
    f"{moment}_{kind}Time{zone}_DateTime"
    for moment in ("Departure", "Arrival")
    for kind in ("Scheduled", "Estimated", "Actual")
    for zone in ("UTC", "Local")
]
LOCAL_TIME_COLUMNS = [c for c in TIME_COLUMNS if c.endswith("TimeLocal_DateTime")]


def align_time_columns(df: DataFrame, names: Iterable[str] = TIME_COLUMNS) -> DataFrame:
    """Add each absent time column as NULL and type every one as timestamp.

    Text columns are parsed from minute text; the schema is inspected at plan
    time so the result is a single projection.
    """
    types = dict(df.dtypes)
    out = {}
    for name in names:
        if name not in types:
            out[name] = F.lit(None).cast("timestamp_ntz")
        elif types[name] == "string":
            out[name] = parse_minute_text(name)
        elif types[name] == "timestamp":
            out[name] = F.col(name).cast("timestamp_ntz")
        elif types[name] != "timestamp_ntz":
            out[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def drop_if_present(df: DataFrame, names: Iterable[str] = LOCAL_TIME_COLUMNS) -> DataFrame:
    """Drop the named columns that exist; absent names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def set_value_where(df: DataFrame, key_column: str, key_value, target_column: str, value) -> DataFrame:
    """Conditional constant correction: ``target := value`` where ``key == key_value``."""
    return df.withColumn(
        target_column,
        F.when(F.col(key_column) == F.lit(key_value), F.lit(value)).otherwise(F.col(target_column)))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
