"""Scans, sources and the append sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.functions.status import status_code_of
from delaykit.functions.text import name_filter
from delaykit.operators.incremental import new_rows_only
from delaykit.registry.base import EVENT_STATUS, EVENT_STATUS_SQL, register, table
from delaykit.sources.files import parse_json_text
from delaykit.sources.landed import kept_pages


@register("json_props_scan", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_props_scan(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", parse_json_text("props", "k int")["k"].alias("k"))


@register("table_scan", "SELECT * FROM orders")
def table_scan(spark, d):
    return table(spark, d, "orders")


@register("filename_filter", """
    SELECT page_id, url, suffix(url, '.html') AS is_html
    FROM pages WHERE contains(url, '/en/') AND NOT contains(url, '?')
""")
def filename_filter(spark, d):
    pages = table(spark, d, "pages")
    return (pages.filter(name_filter("url", contains="/en/", excludes="?"))
                 .select("page_id", "url", F.col("url").endswith(".html").alias("is_html")))


@register("append_new_rows", """
    WITH batch AS (
        SELECT user_id, nullif(event_type, 'view') AS event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
        FROM events),
    stored AS (
        SELECT user_id, nullif(event_type, 'view') AS event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
        FROM events WHERE value < 20)
    SELECT * FROM batch b
    WHERE NOT EXISTS (
        SELECT 1 FROM stored s
        WHERE b.user_id IS NOT DISTINCT FROM s.user_id
          AND b.event_type IS NOT DISTINCT FROM s.event_type
          AND b.day IS NOT DISTINCT FROM s.day)
""")
def append_new_rows(spark, d):
    ev = table(spark, d, "events")
    proj = [F.col("user_id"), F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"),
            F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day")]
    batch = ev.select(*proj)
    stored = ev.filter(F.col("value") < 20).select(*proj)
    return new_rows_only(batch, stored)


@register("landed_pages", f"""
    WITH calls AS (
        SELECT event_id, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
               CAST(floor(hour(ts) / 4) AS INTEGER) AS range_id, {EVENT_STATUS_SQL} AS status
        FROM events),
    ranges AS (
        SELECT day, range_id, arg_max(status, ts) AS last_status FROM calls GROUP BY day, range_id),
    stops AS (
        SELECT day, min(range_id) AS stop_range FROM ranges WHERE last_status NOT IN (200, 404) GROUP BY day)
    SELECT c.event_id, c.day, c.range_id, c.status, m.mode
    FROM calls c JOIN ranges r ON c.day = r.day AND c.range_id = r.range_id
    LEFT JOIN stops s ON c.day = s.day CROSS JOIN (VALUES ('faithful'), ('kept')) m(mode)
    WHERE c.status = 200 AND (r.last_status = 200 OR (m.mode = 'kept' AND r.last_status = 404))
      AND (s.stop_range IS NULL OR c.range_id < s.stop_range)
""")
def landed_pages(spark, d):
    ev = table(spark, d, "events")
    calls = ev.select("event_id", "ts",
                      F.date_format("ts", "yyyy-MM-dd").alias("day"),
                      F.floor(F.hour("ts") / 4).cast("int").alias("range_id"),
                      status_code_of("event_type", EVENT_STATUS).alias("status"))
    columns = ["event_id", "day", "range_id", "status"]
    modes = [kept_pages(calls, "day", "range_id", "ts", "status", faithful_404=f).select(*columns, F.lit(m).alias("mode"))
             for f, m in ((True, "faithful"), (False, "kept"))]
    return modes[0].unionByName(modes[1])
