"""Profiling aggregates (A1-A16) and the flagship delay query."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.functions.status import status_code_of
from delaykit.functions.timefmt import minutes_between
from delaykit.operators import profile as P
from delaykit.operators.dedup import duplicate_count, duplicate_members
from delaykit.operators.nested import endpoint_checksums, pages_of
from delaykit.registry.base import (
    DOCS_LABELS_SQL, EVENT_STATUS, EVENT_STATUS_SQL, FLIGHTS_SQL, docs_labels, flights, register, rnd, table,
)
from delaykit.session import materialize
from delaykit.sources.landed import success_counts


@register("value_counts", """
    SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def value_counts(spark, d):
    return P.value_counts(table(spark, d, "events"), "event_type")


@register("null_count_column", f"SELECT count(*) FILTER (WHERE quality IS NULL) AS n_null FROM ({DOCS_LABELS_SQL}) t")
def null_count_column(spark, d):
    return P.null_count(docs_labels(spark, d), "quality")


_DL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_DL_TYPES = ["bigint", "string", "string", "string", "bigint", "int", "int"]


@register("null_counts_all", f"""
    WITH t AS ({DOCS_LABELS_SQL})
    {' UNION ALL '.join(f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM t" for c in _DL_COLS)}
""")
def null_counts_all(spark, d):
    return P.null_counts(docs_labels(spark, d))


@register("frame_info", f"""
    WITH t AS ({DOCS_LABELS_SQL})
    {' UNION ALL '.join(f"SELECT '{c}' AS column, {i} AS position, count({c}) AS non_null, '{ty}' AS dtype FROM t"
                        for i, (c, ty) in enumerate(zip(_DL_COLS, _DL_TYPES)))}
""")
def frame_info(spark, d):
    return P.frame_info(docs_labels(spark, d))


@register("row_count", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM orders")
def row_count(spark, d):
    return P.shape(table(spark, d, "orders"))


@register("duplicate_count", """
    SELECT (SELECT count(*) FROM lineitem)
         - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) t) AS n_duplicates
""")
def q_duplicate_count(spark, d):
    return duplicate_count(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("duplicate_members_by_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (
        SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def duplicate_members_by_key(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return duplicate_members(li, ["l_orderkey", "l_linenumber"])


@register("duplicate_members_full_row", """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (
        SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def duplicate_members_full_row(spark, d):
    return duplicate_members(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("quartiles", """
    SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75
    FROM lineitem
""")
def quartiles(spark, d):
    q = P.quantiles(table(spark, d, "lineitem"), "l_extendedprice", method="distributed")
    return q.select(rnd(F.col("q25")).alias("q25"), rnd(F.col("q75")).alias("q75"))


DELAY_SQL = f"""
    SELECT l_orderkey, l_linenumber,
           date_diff('microsecond', scheduled_arrival, actual_arrival) / 60000000.0 AS delay_minutes
    FROM ({FLIGHTS_SQL}) f
"""


def delays(spark, d):
    fl = flights(spark, d)
    return fl.select("l_orderkey", "l_linenumber",
                     minutes_between("scheduled_arrival", "actual_arrival").alias("delay_minutes"))


@register("iqr_filter", f"""
    WITH d AS (SELECT l_orderkey, l_linenumber, delay_minutes * CASE WHEN l_linenumber = 7 THEN 6 ELSE 1 END AS delay_minutes
               FROM ({DELAY_SQL}) t),
    q AS (SELECT quantile_cont(delay_minutes, 0.25) AS q1, quantile_cont(delay_minutes, 0.75) AS q3 FROM d)
    SELECT l_orderkey, l_linenumber, round(delay_minutes, 6) AS delay_minutes FROM d, q
    WHERE delay_minutes >= q1 - 1.5 * (q3 - q1) AND delay_minutes <= q3 + 1.5 * (q3 - q1)
""")
def iqr_filter(spark, d):
    # The fences (a subquery) and the filter both need every delay: the flights join
    # runs once into a narrow (key, delay) table in the shared checkpoint folder.
    # Every seventh line of an order is six times as late, so that there are outliers to drop.
    late = F.when(F.col("l_linenumber") == 7, 6).otherwise(1)
    narrow = materialize(delays(spark, d).withColumn("delay_minutes", F.col("delay_minutes") * late), "delays")
    kept = P.iqr_filter(narrow, "delay_minutes")
    return kept.select("l_orderkey", "l_linenumber", rnd(F.col("delay_minutes")).alias("delay_minutes"))


def _shifted_events(spark, d):
    ev = table(spark, d, "events")
    return ev.select("ts", F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts")).alias("ts_shifted"))


@register("day_histogram", """
    WITH e AS (SELECT ts, ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS ts_shifted FROM events
               WHERE ts IS NOT NULL AND value IS NOT NULL),
    s AS (SELECT 'ts' AS series, ts AS t FROM e UNION ALL SELECT 'ts_shifted', ts_shifted FROM e),
    b AS (SELECT CAST(t AS DATE) AS day, series,
                 date_diff('microsecond', CAST(CAST(t AS DATE) AS TIMESTAMP), t) AS m FROM s),
    c AS (SELECT day, series, least(CAST(floor(m * 24 / 86340000000.0) AS INTEGER), 23) AS bin, count(*) AS n
          FROM b WHERE m <= 86340000000 GROUP BY ALL),
    g AS (SELECT day, series, bin FROM (SELECT DISTINCT day FROM b) dd,
          (VALUES ('ts'), ('ts_shifted')) v(series), range(24) r(bin))
    SELECT strftime(g.day, '%Y-%m-%d') AS day, g.series, CAST(g.bin AS INTEGER) AS bin,
           coalesce(c.n, 0) AS count
    FROM g LEFT JOIN c ON g.day = c.day AND g.series = c.series AND g.bin = c.bin
""")
def day_histogram(spark, d):
    h = P.day_histogram(_shifted_events(spark, d), ["ts", "ts_shifted"])
    return h.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("hourly_counts", "SELECT date_trunc('hour', ts) AS hour, count(*) AS count FROM events WHERE ts IS NOT NULL GROUP BY 1")
def hourly_counts(spark, d):
    return P.clock_hour_counts(table(spark, d, "events"), "ts")


@register("range_checksum", """
    SELECT 'orders/' || l_orderkey AS endpoint, count(*) AS n_received, CAST(max(l_linenumber) AS BIGINT) AS n_declared,
           count(*) = max(l_linenumber) AS matches
    FROM lineitem GROUP BY l_orderkey
""")
def range_checksum(spark, d):
    # A landed page per order and discount: the endpoint's pages are received together.
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_discount").agg(
        F.collect_list(F.struct("l_partkey")).alias("flights"), F.max("l_linenumber").alias("most"))
    link = F.array(F.struct(F.concat(F.lit("orders/"), F.col("l_orderkey").cast("string"), F.lit("?offset=0")).alias("@Href")))
    page = F.struct(F.struct(F.col("flights").alias("Flight")).alias("Flights"),
                    F.struct(F.col("most").alias("TotalCount"), link.alias("Link")).alias("Meta"))
    return endpoint_checksums(pages_of(li.select(F.array(F.struct(page.alias("FlightStatusResource"))).alias("data"))))


@register("count_if_status", f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_calls,
           count(*) FILTER (WHERE {EVENT_STATUS_SQL} = 200) AS n_success
    FROM events GROUP BY 1
""")
def count_if_status(spark, d):
    ev = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"),
                                          status_code_of("event_type", EVENT_STATUS).alias("status"))
    return success_counts(ev, ["day"], "status")


@register("argmax", """
    SELECT c_nationkey, c_custkey, c_acctbal FROM (
        SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
        FROM customer WHERE c_acctbal IS NOT NULL) t WHERE rn = 1
""")
def q_argmax(spark, d):
    return P.argmax(table(spark, d, "customer"), ["c_nationkey"], "c_custkey", "c_acctbal")


@register("last_per_key", """
    SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type, max(ts) AS ts
    FROM events GROUP BY user_id
""")
def last_per_key(spark, d):
    return P.last_per_key(table(spark, d, "events"), ["user_id"], "ts", ["event_id", "event_type"])


@register("mean_of_groups", """
    SELECT event_type, round(avg(m), 6) AS mean_value FROM (
        SELECT event_type, user_id, avg(value) AS m FROM events GROUP BY 1, 2) t GROUP BY 1
""")
def mean_of_groups(spark, d):
    ev = table(spark, d, "events")
    per_user = ev.groupBy("event_type", "user_id").agg(F.avg("value").alias("m"))
    return per_user.groupBy("event_type").agg(rnd(F.avg("m")).alias("mean_value"))


@register("neg_mse", """
    SELECT round(-avg(power(l_quantity - (SELECT avg(l_quantity) FROM lineitem), 2)), 6) AS neg_mse FROM lineitem
""")
def q_neg_mse(spark, d):
    li = table(spark, d, "lineitem")
    mean = li.select(F.avg("l_quantity")).scalar()
    return li.agg(rnd(P.neg_mse(F.col("l_quantity"), mean)).alias("neg_mse"))
