"""Constraint checks (Q1-Q5) and the dimension clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.operators import checks as C
from delaykit.plans.airports import clean_airports
from delaykit.registry.base import DOCS_LABELS_SQL, docs_labels, register, rnd, table


@register("check_not_null", f"SELECT doc_id FROM ({DOCS_LABELS_SQL}) t WHERE quality IS NULL OR toxic IS NULL")
def check_not_null(spark, d):
    return C.check_not_null(docs_labels(spark, d), ["doc_id", "quality", "toxic"]).select("doc_id")


@register("check_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def check_unique(spark, d):
    return C.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_foreign_key", """
    SELECT doc_id, source FROM documents d
    WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def check_foreign_key(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return C.check_foreign_key(docs, "doc_id", table(spark, d, "labels"), "doc_id")


@register("check_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def check_length(spark, d):
    return C.check_length(table(spark, d, "part"), {"p_name": 10}).select("p_partkey", "p_name")


@register("daily_rollup", """
    WITH s AS (SELECT CAST(ts AS DATE) AS day, max(value) AS max_value, min(value) AS min_value,
                      round(sum(value), 6) AS sum_value, count(*) AS n FROM events GROUP BY 1),
    c AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS k FROM events GROUP BY 1, 2),
    m AS (SELECT day, event_type AS dominant_event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY day ORDER BY k DESC, event_type) AS rn FROM c) t WHERE rn = 1)
    SELECT strftime(s.day, '%Y-%m-%d') AS day, max_value, min_value, sum_value, n, dominant_event_type
    FROM s LEFT JOIN m ON s.day = m.day
""")
def daily_rollup(spark, d):
    r = C.daily_rollup(table(spark, d, "events"), "ts", [], "value", "event_type")
    return r.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "max_value", "min_value",
                    rnd(F.col("sum_value")).alias("sum_value"), "n", "dominant_event_type")


# Airport stand-in: code = 2 * c_custkey div 3 as text (even codes occur twice, odd ones once),
# NULL for the AUTOMOBILE segment; name = customer name; coordinates from balance and nation.
@register("clean_dimension", """
    WITH air AS (
        SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE CAST((c_custkey * 2) // 3 AS VARCHAR) END AS iata_code,
               c_name AS name, c_acctbal AS latitude_deg, CAST(c_nationkey AS DOUBLE) AS longitude_deg
        FROM customer),
    fixed AS (
        SELECT iata_code, CASE WHEN iata_code = '777' THEN 'Los Angeles International Airport' ELSE name END AS name,
               latitude_deg, longitude_deg
        FROM air WHERE iata_code IS NOT NULL)
    SELECT * FROM fixed WHERE iata_code IN (SELECT iata_code FROM fixed GROUP BY 1 HAVING count(*) = 1)
""")
def clean_dimension(spark, d):
    c = table(spark, d, "customer")
    air = c.select(F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None)).otherwise(F.expr("c_custkey * 2 div 3").cast("string"))
                   .alias("iata_code"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("latitude_deg"),
                   F.col("c_nationkey").cast("double").alias("longitude_deg"))
    return clean_airports(air, fix_code="777")
