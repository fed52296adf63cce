"""Time-text and timestamp expressions.

Flight times arrive as minute-precision text ``yyyy-MM-ddTHH:mm`` with an
optional UTC marker ``Z``.  Timestamps are kept as ``timestamp_ntz`` holding
the UTC wall clock, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm"
_MINUTE_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"
_OFFSET = r"([+-])(\d{2}):?(\d{2})$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_marker(col, marker: str = "Z") -> Column:
    """Remove every occurrence of ``marker`` (F1); null stays null."""
    return F.replace(_c(col), F.lit(marker), F.lit(""))


def parse_minute_text(col) -> Column:
    """Parse ``yyyy-MM-ddTHH:mm``, also with a blank for the ``T``, seconds (and fractions), ``Z`` or an offset, into the
    UTC wall clock as ``timestamp_ntz`` (F6).  Text without zone is UTC; ``10:00+02:00`` is 08:00.

    Malformed text (wrong shape or impossible date) gives NULL rather than an
    error, and nothing depends on the session zone.
    """
    c = _c(col)
    # One regex to validate the shape; the fields are then fixed-position substrings.  Up to ``mmZ`` there are neither
    # seconds nor an offset, so the common texts need no other regex.
    part = lambda pos, n: F.substring(c, pos, n).cast("int")
    short = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), F.lit(0).cast("decimal(8,6)"))
    seconds = F.coalesce(F.nullif(F.regexp_extract(c, r":\d{2}:(\d{2}(?:[.]\d+)?)", 1), F.lit("")), F.lit("0")).cast("decimal(8,6)")
    parsed = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), seconds)
    piece = lambda i: F.regexp_extract(F.substring(c, 17, 40), _OFFSET, i)
    minutes = (F.when(piece(1) == "-", 1).otherwise(-1)) * (piece(2).try_cast("int") * 60 + piece(3).try_cast("int"))
    shifted = F.when(piece(1) == "", parsed).otherwise(F.timestamp_add("MINUTE", minutes, parsed))
    return F.when(c.rlike(_MINUTE_TEXT), F.when(F.length(c) <= 17, short).otherwise(shifted))


def format_minute(col) -> Column:
    """Timestamp to minute text ``yyyy-MM-ddTHH:mm`` (F7); NULL for NULL."""
    return F.date_format(_c(col), MINUTE_FORMAT)


def format_day(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def convert_timezone(col, from_tz: str, to_tz: str, overlap: str = "early") -> Column:
    """Wall-clock conversion between zones of a ``timestamp_ntz`` (F8).

    In the autumn overlap Spark resolves to the earlier instant (summer offset);
    ``overlap="late"`` takes standard time instead, the choice of a
    ``localize`` with its default.  Detected by converting back: when the
    round trip lands one hour earlier the late reading is one hour later.
    """
    c = _c(col)
    out = F.convert_timezone(F.lit(from_tz), F.lit(to_tz), c)
    if overlap == "early":
        return out
    if overlap != "late":
        raise ValueError("overlap must be 'early' or 'late'")
    later = F.timestamp_add("HOUR", F.lit(1), out)
    same_wall = F.convert_timezone(F.lit(to_tz), F.lit(from_tz), later) == c
    return F.when(same_wall, later).otherwise(out)


def _utc_micros(c: Column) -> Column:
    """Microseconds since the epoch of a wall clock read as UTC, whatever the session zone."""
    secs = F.date_part(F.lit("SECOND"), c)
    return F.unix_micros(F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), secs,
                                          F.lit("UTC")))


def minutes_between(start, end) -> Column:
    """Signed fractional minutes ``end - start`` (F9), exact to the microsecond.

    Under a UTC session (the delaykit default) this is a plain
    ``timestamp_diff``; under another zone the wall clocks are read as UTC
    explicitly so a DST change between the two instants cannot shift the result.
    """
    s, e = _c(start), _c(end)
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    zone = active.conf.get("spark.sql.session.timeZone") if active is not None else "UTC"
    if zone.upper() in ("UTC", "GMT", "Z", "+00:00", "ETC/UTC"):
        return F.timestamp_diff("MICROSECOND", s, e) / F.lit(60_000_000.0)
    return (_utc_micros(e) - _utc_micros(s)) / F.lit(60_000_000.0)


def date_minus_days(col, days: int) -> Column:
    """``date - days``, defaulting a NULL date to today."""
    return F.date_sub(F.coalesce(F.to_date(_c(col)), F.current_date()), days)


def four_hour_ranges(start_minute_of_day, range_hours: int = 4) -> Column:
    """Array of range starts (minutes of day) from ``start`` until midnight.

    A start plus N x ``range_hours`` that reaches 24:00 is out of the day and
    excluded, as the range stepping does.
    """
    start = _c(start_minute_of_day)
    step = range_hours * 60
    n_more = F.floor((F.lit(24 * 60 - 1) - start) / F.lit(step))
    return F.transform(F.sequence(F.lit(0), n_more.cast("int")), lambda i: start + i * step)
