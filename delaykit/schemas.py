"""Explicit schemas for the landed documents and the flat tables.

Reading with a declared schema (instead of inference) keeps scans cheap at
scale: no inference pass, and nested pruning can cut unread leaves.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()


def _time() -> T.StructType:
    return T.StructType([T.StructField("DateTime", _S)])


def _point() -> T.StructType:
    return T.StructType([
        T.StructField("AirportCode", _S),
        T.StructField("ScheduledTimeLocal", _time()),
        T.StructField("ScheduledTimeUTC", _time()),
        T.StructField("EstimatedTimeLocal", _time()),
        T.StructField("EstimatedTimeUTC", _time()),
        T.StructField("ActualTimeLocal", _time()),
        T.StructField("ActualTimeUTC", _time()),
        T.StructField("TimeStatus", T.StructType([T.StructField("Code", _S), T.StructField("Definition", _S)])),
        T.StructField("Terminal", T.StructType([T.StructField("Name", _S), T.StructField("Gate", _S)])),
    ])


def _carrier() -> T.StructType:
    return T.StructType([T.StructField("AirlineID", _S), T.StructField("FlightNumber", _S)])


FLIGHT = T.StructType([
    T.StructField("Departure", _point()),
    T.StructField("Arrival", _point()),
    T.StructField("MarketingCarrier", _carrier()),
    T.StructField("OperatingCarrier", _carrier()),
    T.StructField("Equipment", T.StructType([
        T.StructField("AircraftCode", _S), T.StructField("AircraftRegistration", _S)])),
    T.StructField("FlightStatus", T.StructType([T.StructField("Code", _S), T.StructField("Definition", _S)])),
    T.StructField("ServiceType", _S),
])

META = T.StructType([
    T.StructField("TotalCount", T.LongType()),
    T.StructField("Link", T.ArrayType(T.StructType([
        T.StructField("@Href", _S), T.StructField("@Rel", _S)]))),
])

# Container key per API name (fixed values of the flight API).
CONTAINERS = {
    "flightstatus": "FlightStatusResource",
    "customerflightinformation": "FlightInformation",
}


def resource(flight_as_text: bool = False) -> T.StructType:
    """One API page: ``{Flights: {Flight: [..]}, Meta: {...}}``.

    With ``flight_as_text`` the ``Flight`` and ``Link`` nodes are kept as raw JSON
    text so a lone object (instead of an array) can be repaired before parsing.
    """
    flight = _S if flight_as_text else T.ArrayType(FLIGHT)
    meta = T.StructType([META["TotalCount"], T.StructField("Link", _S)]) if flight_as_text else META
    return T.StructType([
        T.StructField("Flights", T.StructType([T.StructField("Flight", flight)])),
        T.StructField("Meta", meta),
    ])


def container_for(api_name: str) -> str:
    """Container key of an API, ``ValueError`` for an unknown API."""
    try:
        return CONTAINERS[api_name]
    except KeyError:
        raise ValueError(f"unknown api_name {api_name!r}; expected one of {sorted(CONTAINERS)}") from None


def landing_file(api_name: str = "flightstatus", flight_as_text: bool = False) -> T.StructType:
    """The landed file: ``{metadata: {...}, data: [page..]}``."""
    return T.StructType([
        T.StructField("metadata", T.StructType([
            T.StructField("initial_flight_endpoint", _S),
            T.StructField("time_at_execution", _S),
            T.StructField("start_range", _S),
            T.StructField("end_range", _S),
        ])),
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField(container_for(api_name), resource(flight_as_text))]))),
    ])


AIRPORTS = T.StructType([
    T.StructField("iata_code", _S),
    T.StructField("name", _S),
    T.StructField("latitude_deg", _D),
    T.StructField("longitude_deg", _D),
])

# The 42 hourly weather variables of the weather API, in API order.
WEATHER_VARIABLES = [
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature", "precipitation_probability",
    "precipitation", "rain", "showers", "snowfall", "snow_depth", "weather_code", "pressure_msl", "surface_pressure",
    "cloud_cover", "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high", "visibility", "evapotranspiration",
    "et0_fao_evapotranspiration", "vapour_pressure_deficit", "wind_speed_10m", "wind_speed_80m", "wind_speed_120m",
    "wind_speed_180m", "wind_direction_10m", "wind_direction_80m", "wind_direction_120m", "wind_direction_180m",
    "wind_gusts_10m", "temperature_80m", "temperature_120m", "temperature_180m", "soil_temperature_0cm",
    "soil_temperature_6cm", "soil_temperature_18cm", "soil_temperature_54cm", "soil_moisture_0_to_1cm",
    "soil_moisture_1_to_3cm", "soil_moisture_3_to_9cm", "soil_moisture_9_to_27cm", "soil_moisture_27_to_81cm",
]

WEATHER = T.StructType(
    [T.StructField("Flight_DateTime", _S), T.StructField("Airport_Code", _S),
     T.StructField("Latitude", _D), T.StructField("Longitude", _D)]
    + [T.StructField(v, _D) for v in WEATHER_VARIABLES]
)

# The five flight columns the ingest keeps in the ``flights`` table.
FLIGHT_TABLE_COLUMNS = [
    "Departure_AirportCode",
    "Departure_ScheduledTimeUTC_DateTime",
    "Arrival_AirportCode",
    "Arrival_ScheduledTimeUTC_DateTime",
    "Arrival_ActualTimeUTC_DateTime",
]

REQUESTS = T.StructType([
    T.StructField("task_uuid", _S),
    T.StructField("arrival_iata_code", _S),
    T.StructField("scheduled_departure_local_time", _S),
])
