"""Nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.functions.timefmt import format_minute
from delaykit.operators.nested import collect_nested, flatten, flights_of, long_to_wide, pages_of
from delaykit.registry.base import register, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("explode_nested", """
    SELECT o.o_orderkey, CAST(row_number() OVER (PARTITION BY o.o_orderkey
               ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) - 1 AS INTEGER) AS pos,
           l.l_linenumber, l.l_partkey
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def explode_nested(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    li = table(spark, d, "lineitem")
    lines = li.withColumn("ord", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    # Pages: one document per order holding its lines in order (the landed shape) ...
    nested = collect_nested(lines, ["l_orderkey"], "ord", ["l_linenumber", "l_partkey"], "Flight")
    page = F.struct(F.struct(F.struct("Flight").alias("Flights")).alias("FlightStatusResource"))
    landed = o.join(nested, o.o_orderkey == nested.l_orderkey).select("o_orderkey", F.array(page).alias("data"))
    # ... unnested back to one row per line with its position.
    flights = flights_of(pages_of(landed, keep=["o_orderkey"]), keep=["o_orderkey"])
    return flights.select("o_orderkey", F.col("flight_pos").cast("int").alias("pos"), "flight.l_linenumber", "flight.l_partkey")


@register("flatten_struct", """
    SELECT o_orderkey, o_orderstatus AS Departure_AirportCode,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M') AS Departure_ScheduledTimeUTC_DateTime,
           o_orderpriority AS Arrival_AirportCode,
           strftime(o_orderdate, '%Y-%m-%dT%H:%MZ') AS Arrival_ScheduledTimeUTC_DateTime
    FROM orders
""")
def flatten_struct(spark, d):
    o = table(spark, d, "orders")
    nested = o.select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("AirportCode"),
                 F.struct(format_minute("o_orderdate").alias("DateTime")).alias("ScheduledTimeUTC")).alias("Departure"),
        F.struct(F.col("o_orderpriority").alias("AirportCode"),
                 F.struct(F.concat(format_minute("o_orderdate"), F.lit("Z")).alias("DateTime")).alias("ScheduledTimeUTC")
                 ).alias("Arrival"))
    return flatten(nested)


@register("collect_nested", """
    SELECT conv_id, count(*) AS n_turns, string_agg(role, ',' ORDER BY turn) AS roles,
           arg_min(role, turn) AS first_role, CAST(sum(length(text)) AS BIGINT) AS total_chars
    FROM conversations GROUP BY conv_id
""")
def q_collect_nested(spark, d):
    conv = table(spark, d, "conversations")
    nested = collect_nested(conv, ["conv_id"], "turn", ["turn", "role", "text"], "turns")
    return nested.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["role"]), ",").alias("roles"),
        F.element_at("turns", 1)["role"].alias("first_role"),
        F.aggregate(F.transform("turns", lambda t: F.length(t["text"]).cast("long")), F.lit(0).cast("long"),
                    lambda acc, x: acc + x).alias("total_chars"))


@register("pivot_variables", f"""
    SELECT user_id, {', '.join(f"round(sum(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in EVENT_TYPES)}
    FROM events GROUP BY user_id
""")
def pivot_variables(spark, d):
    wide = long_to_wide(table(spark, d, "events"), ["user_id"], "event_type", "value", EVENT_TYPES, agg="sum")
    return wide.select("user_id", *[F.round(t, 6).alias(t) for t in EVENT_TYPES])
