"""Weather request builder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.functions.timefmt import format_minute
from delaykit.operators.joins import enrich, zip_checked
from delaykit.operators.ordering import number_within
from delaykit.schemas import WEATHER_VARIABLES

BATCH_SIZE = 50  # coordinates per weather API request (fixed value of the API usage)


def request_rows(flights: DataFrame, airports: DataFrame, code_col: str, time_col: str) -> DataFrame:
    """Distinct (airport, lat, lon, minute) rows for the flights' airports.

    Left join to the airport coordinates, then drop rows lacking the key, a
    coordinate or the time — Catalyst turns the outer join into an inner one.
    The distinct is a map-side partial aggregate.
    """
    req = flights.select(F.col(code_col).alias("airport_code"), format_minute(time_col).alias("flight_minute"))
    enriched = enrich(req, airports, "airport_code", "iata_code",
                      [F.col("latitude_deg").alias("latitude"), F.col("longitude_deg").alias("longitude")],
                      required=["airport_code", "latitude", "longitude", "flight_minute"])
    return enriched.select("airport_code", "latitude", "longitude", "flight_minute").distinct()


def request_batches(flights: DataFrame, airports: DataFrame, code_col: str, time_col: str,
                    batch_size: int = BATCH_SIZE) -> DataFrame:
    """Request rows numbered into batches of ``batch_size`` inside each day.

    A day is numbered over many tasks (``number_within``), so it may hold any number of rows.
    """
    rows = request_rows(flights, airports, code_col, time_col).withColumn("day", F.substring("flight_minute", 1, 10))
    numbered = number_within(rows, ["day"], ["airport_code", "flight_minute", "latitude", "longitude"])
    return numbered.select(
        "day", F.floor((F.col("rn") - 1) / batch_size).cast("int").alias("batch"),
        "airport_code", "latitude", "longitude", "flight_minute", F.lit("GMT").alias("timezone"))


def batch_payloads(batches: DataFrame) -> DataFrame:
    """One row per request: the (at most ``BATCH_SIZE``) coordinates as arrays."""
    return batches.groupBy("day", "batch").agg(
        F.sort_array(F.collect_list(F.struct("airport_code", "flight_minute", "latitude", "longitude"))).alias("points"))


def response_rows(points: DataFrame, responses: DataFrame, variables: Sequence[str] = WEATHER_VARIABLES) -> DataFrame:
    """Landed weather responses -> ``weather_forecasts`` rows (J8 + N4), by key instead of by list position.

    ``points``: the requested rows of ``request_batches`` (day, batch, airport_code, latitude, longitude,
    flight_minute).  ``responses``: one row per point of a request, (day, batch, position, hourly) with ``position``
    the point's place in the request (points sorted as in ``batch_payloads``) and ``hourly`` a struct of ``time`` and
    one array per variable.  The arrays of a response must be equally long (``zip_checked``); the hour that the flight
    minute falls in is kept, and a variable the response lacks is NULL."""
    order = Window.partitionBy("day", "batch").orderBy("airport_code", "flight_minute", "latitude", "longitude")
    numbered = points.withColumn("position", F.row_number().over(order) - 1)  # at most one request's points
    have = [f.name for f in responses.schema["hourly"].dataType.fields]
    flat = responses.select("day", "batch", "position", *[F.col(f"hourly.`{c}`").alias(f"__a_{c}") for c in have])
    rows = zip_checked(flat, ["day", "batch", "position"], {c: f"__a_{c}" for c in have}).drop("pos")
    joined = numbered.join(rows, ["day", "batch", "position"]).filter(
        F.substring("time", 1, 13) == F.substring("flight_minute", 1, 13))
    value = lambda v: (F.col(f"`{v}`") if v in have else F.lit(None)).cast("double").alias(v)
    return joined.select(F.col("flight_minute").alias("Flight_DateTime"), F.col("airport_code").alias("Airport_Code"),
                         F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"),
                         *[value(v) for v in variables])


DATE_IN_NAME = r"\d{4}-\d{2}-\d{2}"  # fixed value: the date pattern of landed file names
WEATHER_KINDS = ("AA", "DA")  # fixed values: arrival- and departure-airport weather file prefixes


def dated_files(listing: DataFrame, kind: bool = False) -> DataFrame:
    """(date, [kind,] file_name) for the files whose name holds a date.

    Files without a date are skipped; when several files share a date (and
    kind) the last one by name wins, as a later listing entry overwrites an
    earlier one.
    """
    from delaykit.functions.text import extract_first

    dated = listing.withColumn("date", extract_first("file_name", DATE_IN_NAME)).filter(F.col("date").isNotNull())
    keys = ["date"]
    if kind:
        dated = dated.withColumn("kind", F.substring_index("file_name", "_", 1))
        keys.append("kind")
    return dated.groupBy(*keys).agg(F.max("file_name").alias("file_name"))


def dates_without_weather(flight_files: DataFrame, weather_files: DataFrame,
                          kinds=WEATHER_KINDS) -> DataFrame:
    """(date, kind, flight file) for every flight date whose weather file of that
    kind is missing (J5).  Keyed by (date, kind): one kind present does not mark
    the date done for the other."""
    flights = dated_files(flight_files).select("date", F.col("file_name").alias("flight_file"))
    wanted = flights.select("date", "flight_file", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"))
    have = dated_files(weather_files, kind=True).select("date", "kind")
    return wanted.join(have, ["date", "kind"], "left_anti")
