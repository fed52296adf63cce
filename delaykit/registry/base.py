"""Registration helpers and the shared stand-in relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.sources.files import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, through ``sources.files.read_table``."""
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def rnd(col, digits: int = 6):
    return F.round(col, digits)


# Flights stand-in: a line item is a flight; the order date is the scheduled
# arrival, the ship date the actual arrival; the customer key (as 3-character
# text) is the arrival airport, the return flag the departure airport.
FLIGHTS_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax,
           l_returnflag AS departure_code,
           CAST(o_custkey AS VARCHAR) AS arrival_code,
           o_orderdate AS scheduled_arrival, l_shipdate AS actual_arrival
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def flights(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax",
                      F.col("l_returnflag").alias("departure_code"),
                      F.col("o_custkey").cast("string").alias("arrival_code"),
                      F.col("o_orderdate").alias("scheduled_arrival"),
                      F.col("l_shipdate").alias("actual_arrival")))


# Documents with their (partial) labels: the left join yields real NULLs.
DOCS_LABELS_SQL = """
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def docs_labels(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


# Status code of an event seen as an API call (fixed stand-in mapping).
EVENT_STATUS = {"view": 200, "click": 200, "purchase": 200, "signup": 404, "error": 500}
EVENT_STATUS_SQL = ("CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 200 "
                    "WHEN 'purchase' THEN 200 WHEN 'signup' THEN 404 ELSE 500 END")
