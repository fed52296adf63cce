"""Text expressions on keys, URLs and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_left(col, n: int) -> Column:
    """First ``n`` characters (the date prefix of a time text)."""
    return F.substring(_c(col), 1, n)


def text_right(col, n: int) -> Column:
    """Last ``n`` characters, the whole text when shorter."""
    return F.right(_c(col), F.lit(n))


def extract_first(col, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern``; NULL when the text has none."""
    c = _c(col)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def url_base(col) -> Column:
    """Part before the first ``?``."""
    return F.substring_index(_c(col), "?", 1)


def name_filter(col, contains: str | None = None, excludes: str | None = None,
                suffix: str | None = None) -> Column:
    """Boolean predicate on a name: contains / does not contain / ends with (P10)."""
    c = _c(col)
    cond = F.lit(True)
    if contains is not None:
        cond = cond & c.contains(contains)
    if excludes is not None:
        cond = cond & ~c.contains(excludes)
    if suffix is not None:
        cond = cond & c.endswith(suffix)
    return cond


def flight_url(base_url: str, departure, date_text, time_text=None, arrival=None,
               api_name: str = "flightstatus") -> Column:
    """Flight API URL per row (F5): ``departures`` mode when the arrival is NULL,
    ``route`` mode otherwise."""
    dep, day = _c(departure), _c(date_text)
    time_text = F.lit("00:00") if time_text is None else _c(time_text)
    arrival = F.lit(None).cast("string") if arrival is None else _c(arrival)
    prefix = F.lit(f"{base_url}/operations/{api_name}/")
    departures = F.concat(prefix, F.lit("departures/"), dep, F.lit("/"), day, F.lit("T"), time_text)
    route = F.concat(prefix, F.lit("route/"), dep, F.lit("/"), arrival, F.lit("/"), day)
    return F.when(arrival.isNull(), departures).otherwise(route)


def flight_file_base(airport, date_text, api_name: str = "flightstatus") -> Column:
    """Landing file name base ``{iata}_{api}_dep_flights_{date}``."""
    return F.concat(_c(airport), F.lit(f"_{api_name}_dep_flights_"), _c(date_text))
