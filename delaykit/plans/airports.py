"""Airport dimension clean-up (B3) and coordinate lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delaykit.operators.dedup import keep_unique_keys
from delaykit.operators.filters import drop_incomplete, set_value_where
from delaykit.operators.joins import lookup_or_null

# The one airport whose missing name is corrected.
LAX_CODE = "LAX"
LAX_NAME = "Los Angeles International Airport"


def clean_airports(airports: DataFrame, code_col: str = "iata_code", name_col: str = "name",
                   fix_code: str = LAX_CODE, fix_name: str = LAX_NAME) -> DataFrame:
    """Rows without a code dropped, then the name fix, then every row of a
    duplicated code dropped (none kept) — in that order."""
    out = drop_incomplete(airports, [code_col])
    out = set_value_where(out, code_col, fix_code, name_col, fix_name)
    return keep_unique_keys(out, [code_col])


def coordinates(requests: DataFrame, airports: DataFrame, request_code: str,
                code_col: str = "iata_code") -> DataFrame:
    """Latitude/longitude of each request's airport, NULLs when unknown."""
    return lookup_or_null(requests, airports, request_code, code_col,
                          ["latitude_deg", "longitude_deg"], ["latitude_deg", "longitude_deg"])
