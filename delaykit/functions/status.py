"""Call-status mapping (P12): the HTTP code decides what a call yields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def status_state(code) -> Column:
    """200 data, 403 retry (rate limit), 404 empty range, anything else error."""
    c = _c(code)
    return (F.when(c == 200, "data").when(c == 403, "retry")
            .when(c == 404, "empty").otherwise("error"))


def status_code_of(kind, mapping: dict[str, int], default: int = 500) -> Column:
    """Map a categorical column to status codes with a literal CASE (no join)."""
    c = _c(kind)
    expr = None
    for key, value in mapping.items():
        expr = F.when(c == key, F.lit(value)) if expr is None else expr.when(c == key, F.lit(value))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def outcome(code, value, message) -> Column:
    """Request outcome struct: success -> (200, value, message); else (400, "", message)."""
    ok = _c(code) == 200
    return F.struct(
        F.when(ok, F.lit(200)).otherwise(F.lit(400)).alias("status_code"),
        F.when(ok, _c(value).cast("string")).otherwise(F.lit("")).alias("value"),
        _c(message).alias("message"),
    )
