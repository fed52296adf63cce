"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.functions.status import outcome, status_code_of, status_state
from delaykit.functions.timefmt import format_minute
from delaykit.operators.filters import (
    TIME_COLUMNS, align_time_columns, drop_if_present, drop_incomplete, filter_equals,
    select_columns, set_value_where, where_not_null, where_null, with_defaults,
)
from delaykit.registry.base import (
    DOCS_LABELS_SQL, EVENT_STATUS, EVENT_STATUS_SQL, docs_labels, register, table,
)

LINE_MEASURES = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("select_features", f"SELECT {', '.join(LINE_MEASURES)} FROM lineitem")
def select_features(spark, d):
    return select_columns(table(spark, d, "lineitem"), LINE_MEASURES)


@register("filter_equals", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def q_filter_equals(spark, d):
    return filter_equals(table(spark, d, "orders"), "o_orderstatus", "F")


@register("dropna_subset", f"""
    SELECT doc_id, lang, quality, toxic FROM ({DOCS_LABELS_SQL}) t
    WHERE quality IS NOT NULL AND toxic IS NOT NULL
""")
def dropna_subset(spark, d):
    return drop_incomplete(docs_labels(spark, d), ["quality", "toxic"]).select("doc_id", "lang", "quality", "toxic")


@register("filter_is_null", f"SELECT doc_id, source FROM ({DOCS_LABELS_SQL}) t WHERE quality IS NULL")
def filter_is_null(spark, d):
    return where_null(docs_labels(spark, d), "quality").select("doc_id", "source")


@register("filter_not_null", f"SELECT doc_id, source, quality FROM ({DOCS_LABELS_SQL}) t WHERE quality IS NOT NULL")
def filter_not_null(spark, d):
    return where_not_null(docs_labels(spark, d), "quality").select("doc_id", "source", "quality")


def _aligned(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("Departure_ScheduledTimeUTC_DateTime"),
        F.concat(format_minute("o_orderdate"), F.lit("Z")).alias("Arrival_ScheduledTimeUTC_DateTime"))
    return align_time_columns(o)


def _aligned_sql(columns):
    present = {"Departure_ScheduledTimeUTC_DateTime": "o_orderdate",
               "Arrival_ScheduledTimeUTC_DateTime": "o_orderdate"}
    cols = [f"{present[c]} AS {c}" if c in present else f"CAST(NULL AS TIMESTAMP) AS {c}" for c in columns]
    return f"SELECT o_orderkey, {', '.join(cols)} FROM orders"


@register("align_date_columns", _aligned_sql(TIME_COLUMNS))
def align_date_columns(spark, d):
    return _aligned(spark, d).select("o_orderkey", *TIME_COLUMNS)


@register("drop_columns", _aligned_sql([c for c in TIME_COLUMNS if "Local" not in c]))
def drop_columns(spark, d):
    return drop_if_present(_aligned(spark, d))


@register("conditional_fix", """
    SELECT n_nationkey,
           CASE WHEN n_nationkey = 7 THEN 'Los Angeles International Airport' ELSE n_name END AS n_name,
           n_regionkey
    FROM nation
""")
def conditional_fix(spark, d):
    return set_value_where(table(spark, d, "nation"), "n_nationkey", 7, "n_name",
                           "Los Angeles International Airport")


@register("default_value", f"""
    SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM ({DOCS_LABELS_SQL}) t
""")
def default_value(spark, d):
    return with_defaults(docs_labels(spark, d), {"quality": -1, "toxic": -1}).select("doc_id", "quality", "toxic")


@register("status_mapping", f"""
    WITH c AS (SELECT event_id, event_type, value,
                      CASE WHEN event_type = 'purchase' THEN 403 ELSE {EVENT_STATUS_SQL} END AS code FROM events)
    SELECT event_id, code,
           CASE WHEN code = 200 THEN 'data' WHEN code = 403 THEN 'retry' WHEN code = 404 THEN 'empty'
                ELSE 'error' END AS state,
           CASE WHEN code = 200 THEN 200 ELSE 400 END AS status_code,
           CASE WHEN code = 200 THEN printf('%.2f', value) ELSE '' END AS result,
           event_type AS message
    FROM c
""")
def status_mapping(spark, d):
    ev = table(spark, d, "events").withColumn("code", status_code_of("event_type", EVENT_STATUS | {"purchase": 403}))
    out = outcome("code", F.format_string("%.2f", F.col("value")), F.col("event_type"))
    return ev.select("event_id", "code", status_state("code").alias("state"), out.alias("o")).select(
        "event_id", "code", "state", F.col("o.status_code").alias("status_code"),
        F.col("o.value").alias("result"), F.col("o.message").alias("message"))
