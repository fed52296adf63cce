"""Keys of the streaming jobs: tables derived from the driver tables are replayed as file streams, to the end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from delaykit.functions.timefmt import format_minute
from delaykit.registry.base import FLIGHTS_SQL, flights, register, table
from delaykit.session import materialize, scratch_path
from delaykit.streaming.waiting import waiting_matches

# An order asks for the flight of its own day from 'R' to its customer.  That flight is known when it was receipted, its
# weather 30 hours later; customers divisible by 5 have no weather.  A request waits 1000 hours and 17 minutes.
_WAIT, _KEEP, _LATE = "1000 HOURS 17 MINUTES", "10 HOURS", "0 MINUTES"


@register("waiting_requests", f"""
    WITH f AS (SELECT arrival_code AS c, scheduled_arrival AS t, min(actual_arrival) AS known_at, avg(l_quantity) AS q
               FROM ({FLIGHTS_SQL}) x WHERE departure_code = 'R' AND actual_arrival IS NOT NULL AND scheduled_arrival IS NOT NULL GROUP BY 1, 2),
    w AS (SELECT c, t, known_at + INTERVAL 30 HOUR AS known_at, q FROM f WHERE CAST(c AS INTEGER) % 5 <> 0),
    r AS (SELECT 'req-' || o_orderkey AS task_uuid, CAST(o_custkey AS VARCHAR) AS c, o_orderdate AS t FROM orders WHERE o_orderdate IS NOT NULL),
    m AS (SELECT least((SELECT max(t) FROM r), (SELECT max(known_at) FROM f), (SELECT max(known_at) FROM w)) AS mark),
    j AS (SELECT r.task_uuid, r.t, f.c IS NOT NULL AS has_flight, w.c IS NOT NULL AS has_weather, w.q
          FROM r LEFT JOIN f ON r.c = f.c AND r.t = f.t AND f.known_at BETWEEN r.t - INTERVAL 10 HOUR AND r.t + INTERVAL 1000 HOUR + INTERVAL 17 MINUTE
          LEFT JOIN w ON f.c = w.c AND f.t = w.t AND w.known_at BETWEEN r.t - INTERVAL 10 HOUR AND r.t + INTERVAL 1000 HOUR + INTERVAL 17 MINUTE)
    SELECT task_uuid, has_flight, has_weather, round(q, 6) AS quantity FROM j CROSS JOIN m
    WHERE has_weather OR t + INTERVAL 1000 HOUR + INTERVAL 17 MINUTE
          + CASE WHEN has_flight THEN INTERVAL 1000 HOUR + INTERVAL 17 MINUTE ELSE INTERVAL 0 HOUR END < mark
""")
def q_waiting_requests(spark, d):
    o = table(spark, d, "orders").filter("o_orderdate IS NOT NULL")
    requests = o.select(F.concat(F.lit("req-"), F.col("o_orderkey").cast("string")).alias("task_uuid"),
                        F.col("o_custkey").cast("string").alias("arrival_iata_code"),
                        format_minute("o_orderdate").alias("scheduled_departure_local_time"),
                        F.col("o_orderdate").cast("timestamp").alias("requested_at"))
    fl = flights(spark, d).filter("departure_code = 'R' AND actual_arrival IS NOT NULL AND scheduled_arrival IS NOT NULL")
    found = materialize(fl.groupBy("arrival_code", "scheduled_arrival").agg(
        F.min("actual_arrival").cast("timestamp").alias("known_at"), F.avg("l_quantity").alias("quantity")), "first-flights")
    minute = format_minute("scheduled_arrival")
    first = found.select(F.col("arrival_code").alias("Arrival_AirportCode"), minute.alias("Departure_ScheduledTimeLocal_DateTime"),
                         minute.alias("Arrival_ScheduledTimeUTC_DateTime"), "known_at")
    weather = (found.filter(F.col("arrival_code").cast("int") % 5 != 0)
               .select(F.col("arrival_code").alias("Airport_Code"), minute.alias("Flight_DateTime"), "quantity",
                       (F.col("known_at") + F.expr("INTERVAL 30 HOURS")).alias("known_at")))

    def replayed(df, name):
        path = scratch_path(spark, f"delaykit-{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.readStream.schema(df.schema).parquet(path)

    out, state = (scratch_path(spark, f"delaykit-waiting-{part}-{uuid.uuid4().hex}") for part in ("out", "state"))
    matches = waiting_matches(replayed(requests, "requests"), replayed(first, "flights"), replayed(weather, "weather"),
                              ["quantity"], wait=_WAIT, keep=_KEEP, late=_LATE)
    (matches.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
     .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.schema(matches.schema).parquet(out)
    return got.select("task_uuid", "has_flight", "has_weather", F.round("quantity", 6).alias("quantity"))
