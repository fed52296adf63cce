"""Scalar functions (F1-F13) and the weather request builder (B2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.functions import text as TX
from delaykit.functions import timefmt as TF
from delaykit.plans.weather import request_batches
from delaykit.registry.base import FLIGHTS_SQL, flights, register, rnd, table
from delaykit.registry.profile import DELAY_SQL, delays


@register("strip_marker", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%MZ') AS raw, replace(strftime(ts, '%Y-%m-%dT%H:%MZ'), 'Z', '') AS stripped
    FROM events
""")
def strip_marker(spark, d):
    ev = table(spark, d, "events").select("event_id", F.concat(TF.format_minute("ts"), F.lit("Z")).alias("raw"))
    return ev.withColumn("stripped", TF.strip_marker("raw"))


@register("text_slices", """
    SELECT page_id, left(url, 10) AS head10, right(url, 5) AS tail5, right(url, 16) AS tail16 FROM pages
""")
def text_slices(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", TX.text_left("url", 10).alias("head10"), TX.text_right("url", 5).alias("tail5"),
                    TX.text_right("url", 16).alias("tail16"))


@register("regex_extract", """
    SELECT page_id, regexp_extract(url, '/([0-9]+)', 1) AS path_id FROM pages WHERE regexp_matches(url, '/([0-9]+)')
""")
def regex_extract(spark, d):
    p = table(spark, d, "pages").select("page_id", TX.extract_first("url", r"/([0-9]+)", 1).alias("path_id"))
    return p.filter(F.col("path_id").isNotNull())


@register("url_base", "SELECT page_id, split_part(url, '?', 1) AS base FROM pages")
def url_base(spark, d):
    return table(spark, d, "pages").select("page_id", TX.url_base("url").alias("base"))


BASE_URL = "https://api.example.invalid/v1"


@register("build_key", f"""
    WITH o AS (SELECT o_orderkey, o_orderstatus AS dep, nullif(o_orderpriority, '5-LOW') AS arr,
                      strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
    SELECT o_orderkey,
           CASE WHEN arr IS NULL THEN '{BASE_URL}/operations/flightstatus/departures/' || dep || '/' || day || 'T00:00'
                ELSE '{BASE_URL}/operations/flightstatus/route/' || dep || '/' || arr || '/' || day END AS url,
           dep || '_flightstatus_dep_flights_' || day AS file_base
    FROM o
""")
def build_key(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("dep"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("arr"), TF.format_day("o_orderdate").alias("day"))
    return o.select("o_orderkey", TX.flight_url(BASE_URL, "dep", "day", arrival=F.col("arr")).alias("url"),
                    TX.flight_file_base("dep", "day").alias("file_base"))


_TIME_TEXT_SQL = """CASE event_type WHEN 'error' THEN 'not-a-time'
                      WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%MZ') ELSE strftime(ts, '%Y-%m-%dT%H:%M') END"""


@register("parse_timestamp", f"""
    SELECT event_id, {_TIME_TEXT_SQL} AS text,
           CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('minute', ts) END AS parsed
    FROM events
""")
def parse_timestamp(spark, d):
    ev = table(spark, d, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("not-a-time"))
             .when(F.col("event_type") == "view", F.concat(TF.format_minute("ts"), F.lit("Z")))
             .otherwise(TF.format_minute("ts")))
    return ev.select("event_id", text.alias("text")).withColumn("parsed", TF.parse_minute_text("text"))


@register("format_minute", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS minute_text, strftime(ts, '%Y-%m-%d') AS day_text FROM events
""")
def format_minute(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", TF.format_minute("ts").alias("minute_text"), TF.format_day("ts").alias("day_text"))


@register("convert_timezone", """
    SELECT event_id,
           strftime(timezone('UTC', timezone('Europe/Berlin', date_trunc('day', ts) + to_minutes(720 + minute(ts))
                                              + to_days(CAST(event_id % 365 AS INTEGER)))), '%Y-%m-%dT%H:%M') AS utc_text
    FROM events
""")
def convert_timezone(spark, d):
    ev = table(spark, d, "events")
    # Noons spread over a year: summer and standard time (the hours of the changes themselves are in the tests).
    noon = F.timestamp_add("MINUTE", 720 + F.minute("ts"), F.date_trunc("day", "ts").cast("timestamp_ntz"))
    local = F.timestamp_add("DAY", (F.col("event_id") % 365).cast("int"), noon)
    return ev.select("event_id", TF.format_minute(TF.convert_timezone(local, "Europe/Berlin", "UTC")).alias("utc_text"))


@register("delay_minutes", f"SELECT l_orderkey, l_linenumber, round(delay_minutes, 6) AS delay_minutes FROM ({DELAY_SQL}) t")
def delay_minutes(spark, d):
    return delays(spark, d).withColumn("delay_minutes", rnd(F.col("delay_minutes")))


@register("date_minus_days", """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS minus1,
           strftime(CAST(o_orderdate AS DATE) - 3, '%Y-%m-%d') AS minus3 FROM orders
""")
def date_minus_days(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", TF.format_day(TF.date_minus_days("o_orderdate", 1)).alias("minus1"),
                    TF.format_day(TF.date_minus_days("o_orderdate", 3)).alias("minus3"))


@register("four_hour_ranges", """
    WITH e AS (SELECT event_id, hour(ts) * 60 + minute(ts) AS start_min FROM events),
    r AS (SELECT event_id, unnest(range(start_min, 1440, 240)) AS range_start FROM e)
    SELECT event_id, CAST((range_start - start_min) / 240 AS INTEGER) AS range_no,
           lpad(CAST(range_start // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(range_start % 60 AS VARCHAR), 2, '0') AS range_start
    FROM r JOIN e USING (event_id)
""")
def four_hour_ranges(spark, d):
    ev = table(spark, d, "events").select("event_id", (F.hour("ts") * 60 + F.minute("ts")).alias("start_min"))
    ex = ev.select("event_id", F.posexplode(TF.four_hour_ranges(F.col("start_min"))).alias("range_no", "m"))
    hhmm = F.format_string("%02d:%02d", F.floor(F.col("m") / 60).cast("int"), (F.col("m") % 60).cast("int"))
    return ex.select("event_id", F.col("range_no").cast("int").alias("range_no"), hhmm.alias("range_start"))


@register("array_basics", """
    SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value, len(embedding) AS n,
           round(CAST(embedding[-1] AS DOUBLE), 6) AS last_value FROM embeddings
""")
def array_basics(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", rnd(F.element_at("embedding", 1).cast("double")).alias("first_value"),
                    F.size("embedding").cast("long").alias("n"), rnd(F.element_at("embedding", -1).cast("double")).alias("last_value"))


# Weather requests: flights x cleaned airports -> distinct (airport, lat, lon, minute) rows,
# numbered per day in batches of 50 (one batch = one weather API request).
@register("weather_request_batches", f"""
    WITH f AS (SELECT arrival_code, date_trunc('month', scheduled_arrival) AS scheduled_arrival FROM ({FLIGHTS_SQL}) t),
    air AS (SELECT CAST(c_custkey AS VARCHAR) AS iata_code, c_acctbal AS latitude_deg, CAST(c_nationkey AS DOUBLE) AS longitude_deg
            FROM customer),
    m AS (SELECT DISTINCT f.arrival_code AS airport_code, a.latitude_deg AS latitude, a.longitude_deg AS longitude,
                 strftime(f.scheduled_arrival, '%Y-%m-%dT%H:%M') AS flight_minute
          FROM f LEFT JOIN air a ON f.arrival_code = a.iata_code
          WHERE f.arrival_code IS NOT NULL AND a.latitude_deg IS NOT NULL AND a.longitude_deg IS NOT NULL
            AND f.scheduled_arrival IS NOT NULL),
    n AS (SELECT *, left(flight_minute, 10) AS day,
                 row_number() OVER (PARTITION BY left(flight_minute, 10)
                                    ORDER BY airport_code, flight_minute, latitude, longitude) AS rn FROM m)
    SELECT day, CAST((rn - 1) // 50 AS INTEGER) AS batch, airport_code, latitude, longitude, flight_minute,
           'GMT' AS timezone
    FROM n
""")
def weather_request_batches(spark, d):
    c = table(spark, d, "customer")
    air = c.select(F.col("c_custkey").cast("string").alias("iata_code"), F.col("c_acctbal").alias("latitude_deg"),
                   F.col("c_nationkey").cast("double").alias("longitude_deg"))
    # Every flight on the first of its month: days with several batches.
    monthly = flights(spark, d).withColumn("scheduled_arrival", F.date_trunc("month", "scheduled_arrival"))
    return request_batches(monthly, air, "arrival_code", "scheduled_arrival")
