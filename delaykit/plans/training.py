"""Training table: flights cleaned, joined to weather, label in minutes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.functions.timefmt import minutes_between, parse_minute_text, strip_marker
from delaykit.operators.asof import asof_join
from delaykit.operators.filters import drop_incomplete, select_columns
from delaykit.operators.joins import join_on_keys, salted_join
from delaykit.operators.skew import join_hot_keys
from delaykit.schemas import WEATHER_VARIABLES

ACTUAL = "Arrival_ActualTimeUTC_DateTime"
SCHEDULED = "Arrival_ScheduledTimeUTC_DateTime"
DEPARTURE = "Departure_ScheduledTimeUTC_DateTime"


def prepare_flights_for_training(flights: DataFrame, actual: str = ACTUAL, scheduled: str = SCHEDULED) -> DataFrame:
    """Drop flights missing the actual or scheduled arrival (M1)."""
    return drop_incomplete(flights, [actual, scheduled])


def features_from_flights(flights: DataFrame, time_cols: Sequence[str] = (DEPARTURE, SCHEDULED)) -> DataFrame:
    """Remove the UTC marker from the time texts so they match weather keys (M1, F1)."""
    return flights.withColumns({c: strip_marker(c) for c in time_cols})


def merge_flights_weather(flights: DataFrame, weather: DataFrame,
                          flight_keys: Sequence[str] = ("Arrival_AirportCode", SCHEDULED),
                          weather_keys: Sequence[str] = ("Airport_Code", "Flight_DateTime"),
                          salt_buckets: int = 0, find_hot: bool = False) -> DataFrame:
    """Inner join on (airport, minute) (J4); duplicate weather rows fan out.

    Both sides shuffle on the two keys; a hub airport holding a large share of
    the flights is split by AQE's skew handling.  When the weather side may
    repeat a hot key many times too, ``find_hot`` finds the hot keys (one pass)
    and salts just those; ``salt_buckets`` > 1 salts every key.
    """
    if find_hot:
        return join_hot_keys(flights, weather, list(flight_keys), list(weather_keys))
    if salt_buckets > 1:
        return salted_join(flights, weather, list(flight_keys), list(weather_keys), salt_buckets)
    return join_on_keys(flights, weather, list(flight_keys), list(weather_keys), "inner")


def merge_flights_weather_hourly(flights: DataFrame, weather: DataFrame, flight_time: str, weather_time: str,
                                 feature_cols: Sequence[str] = WEATHER_VARIABLES, flight_key: str = "Arrival_AirportCode",
                                 weather_key: str = "Airport_Code", max_hours: int | None = 1) -> DataFrame:
    """Every flight with the latest forecast of its airport not after its time, at most ``max_hours`` old (J4 by the hour):
    forecasts are hourly, flights to the minute.  Times are timestamps; flights without a forecast have NULL features."""
    within = None if max_hours is None else F.make_dt_interval(hours=F.lit(max_hours))
    return asof_join(flights, weather, [flight_key], [weather_key], flight_time, weather_time, feature_cols, within)


def delay_label(actual, scheduled, name: str = "delay_minutes"):
    """Label: signed minutes from scheduled to actual arrival, parsed from text when needed."""
    def ts(c):
        return parse_minute_text(c) if isinstance(c, str) else c
    return minutes_between(ts(scheduled), ts(actual)).alias(name)


def training_table(merged: DataFrame, key_cols: Sequence[str], feature_cols: Sequence[str] = WEATHER_VARIABLES,
                   actual=ACTUAL, scheduled=SCHEDULED) -> DataFrame:
    """One table holding key, features and label side by side (M2 + J9).

    The reference writes features and label to two tables aligned by row
    position; here they never leave the row they belong to.
    """
    cols = select_columns(merged, [*key_cols, *feature_cols]).columns
    return merged.select(*[F.col(c) for c in cols], delay_label(actual, scheduled))
