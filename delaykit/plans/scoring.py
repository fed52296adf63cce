"""Batch (and streaming) scoring of prediction requests.

A request names an arrival airport and a scheduled local departure time.
Per request: the first flight with that departure time, the arrival
airport's weather at the flight's scheduled arrival minute, the model's
prediction — or ``failed`` when any step finds nothing.  Everything is a
chain of left joins over the whole request table, so a stream of requests can
use the same function (stream-static joins).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.operators.joins import first_per_key
from delaykit.plans.models import predict


def first_flight_per_request(flights: DataFrame, code_col: str, departure_col: str, order_cols: Sequence[str],
                             value_cols: Sequence[str], departure: str | None = None,
                             departure_code_col: str = "Departure_AirportCode") -> DataFrame:
    """First flight per (arrival airport, departure time) (O4), as a keyed table; with ``departure`` only of the
    flights that leave from that airport."""
    if departure is not None:
        flights = flights.filter(F.col(departure_code_col) == departure)
    return first_per_key(flights, [code_col, departure_col], order_cols, value_cols)


def latest_weather(weather: DataFrame, feature_cols: Sequence[str], weather_code: str = "Airport_Code",
                   weather_time: str = "Flight_DateTime", order_cols: Sequence[str] = ()) -> DataFrame:
    """One weather row per (airport, minute): the last by ``order_cols`` (e.g. the time it was fetched), else the
    largest by its features, so that forecasts stored twice give one prediction."""
    order = F.struct(*[F.col(c) for c in (order_cols or feature_cols)])
    last = weather.groupBy(weather_code, weather_time).agg(F.max_by(F.struct(*feature_cols), order).alias("__w"))
    return last.select(weather_code, weather_time, *[F.col(f"__w.`{c}`").alias(c) for c in feature_cols])


def score_requests(requests: DataFrame, flights_first: DataFrame, weather: DataFrame, model: PipelineModel,
                   feature_cols: Sequence[str], req_code: str = "arrival_iata_code",
                   req_time: str = "scheduled_departure_local_time", flight_code: str = "Arrival_AirportCode",
                   flight_time: str = "Departure_ScheduledTimeLocal_DateTime",
                   flight_arrival: str = "Arrival_ScheduledTimeUTC_DateTime",
                   weather_code: str = "Airport_Code", weather_time: str = "Flight_DateTime",
                   weather_order: Sequence[str] = ()) -> DataFrame:
    """(task_uuid, state, prediction, message), one row for every request: flights and weather have one row a key."""
    f = flights_first.select(F.col(flight_code).alias("__fc"), F.col(flight_time).alias("__ft"),
                             F.col(flight_arrival).alias("__fa"))
    matched = requests.join(f, (requests[req_code] == f["__fc"]) & (requests[req_time] == f["__ft"]), "left")
    weather = latest_weather(weather, feature_cols, weather_code, weather_time, weather_order)
    w = weather.select(F.col(weather_code).alias("__wc"), F.col(weather_time).alias("__wt"), *feature_cols)
    enriched = matched.join(w, (matched["__fc"] == w["__wc"]) & (matched["__fa"] == w["__wt"]), "left")
    return answers(predict(model, enriched, feature_cols), F.col("__fc").isNotNull(), F.col("__wc").isNotNull())


def answers(scored: DataFrame, has_flight: Column, has_weather: Column) -> DataFrame:
    """(task_uuid, state, prediction, message) of scored requests: ``failed`` with the first thing that was missing."""
    state = F.when(F.col("prediction").isNotNull(), F.lit("success")).otherwise(F.lit("failed"))
    message = (F.when(~has_flight, F.lit("no flight at that departure time"))
                .when(~has_weather, F.lit("no weather forecast for the flight"))
                .when(F.col("prediction").isNull(), F.lit("incomplete features"))
                .otherwise(F.lit("delay predicted")))
    return scored.select("task_uuid", state.alias("state"), "prediction", message.alias("message"))
