"""Joins (J1, J2, J4-J8) and the insert operators that rest on anti joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.operators.incremental import content_hash, early_stop_across_files, early_stop_flags, insert_if_absent
from delaykit.operators.joins import (
    distinct_then_enrich, enrich, join_on_keys, lookup_or_null, missing_keys, zip_checked,
)
from delaykit.operators.skew import join_hot_keys
from delaykit.plans.training import merge_flights_weather_hourly
from delaykit.registry.base import register, table


@register("enrich_left_join", """
    SELECT d.doc_id, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN (SELECT doc_id, quality, toxic FROM labels) l ON d.doc_id = l.doc_id
    WHERE l.doc_id IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")
def enrich_left_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    return enrich(docs, table(spark, d, "labels"), "doc_id", "doc_id", ["quality", "toxic"],
                  required=["quality", "toxic"])


@register("distinct_then_enrich", """
    SELECT o.o_custkey, o.order_day, c.c_nationkey, c.c_acctbal
    FROM (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders) o
    LEFT JOIN (SELECT c_custkey, nullif(c_nationkey, 3) AS c_nationkey, c_acctbal FROM customer) c ON o.o_custkey = c.c_custkey
    WHERE c.c_nationkey IS NOT NULL AND c.c_acctbal IS NOT NULL
""")
def q_distinct_then_enrich(spark, d):
    o = table(spark, d, "orders").withColumn("order_day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    c = table(spark, d, "customer").withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3)))
    return distinct_then_enrich(o, ["o_custkey", "order_day"], "o_custkey", c,
                                "c_custkey", ["c_nationkey", "c_acctbal"], required=["c_nationkey", "c_acctbal"])


@register("join_two_keys", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, w.l_tax AS w_tax
    FROM lineitem l
    JOIN (SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_returnflag = 'R') w
      ON l.l_orderkey = w.l_orderkey AND l.l_linenumber = w.l_linenumber
""")
def q_join_two_keys(spark, d):
    li = table(spark, d, "lineitem")
    left = li.select("l_orderkey", "l_linenumber", "l_partkey")
    wx = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("w_orderkey"), F.col("l_linenumber").alias("w_linenumber"),
        F.col("l_tax").alias("w_tax"))
    return (join_on_keys(left, wx, ["l_orderkey", "l_linenumber"], ["w_orderkey", "w_linenumber"])
            .select("l_orderkey", "l_linenumber", "l_partkey", "w_tax"))


@register("missing_keys", """
    SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def q_missing_keys(spark, d):
    return missing_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "doc_id").select("doc_id")


@register("lookup_or_null", """
    WITH firsts AS (
        SELECT doc_id, quality, toxic FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) AS rn
            FROM (SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, 1 - quality, toxic FROM labels) b) t
        WHERE rn = 1)
    SELECT d.doc_id, CAST(f.quality AS DOUBLE) AS quality, CAST(f.toxic AS DOUBLE) AS toxic
    FROM documents d LEFT JOIN firsts f ON d.doc_id = f.doc_id
""")
def q_lookup_or_null(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    labels = table(spark, d, "labels")
    both = labels.unionByName(labels.withColumn("quality", 1 - F.col("quality")))  # two rows a key: the first by order counts
    out = lookup_or_null(docs, both, "doc_id", "doc_id", ["quality", "toxic"], ["quality", "toxic"])
    # doubles: an integer column holding NULLs converts the same way in every client
    return out.select("doc_id", F.col("quality").cast("double"), F.col("toxic").cast("double"))


@register("zip_arrays", """
    SELECT vec_id, CAST(idx AS INTEGER) AS pos, round(CAST(value AS DOUBLE), 6) AS value,
           round(CAST(reversed AS DOUBLE), 6) AS reversed FROM (
        SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS idx, unnest(embedding) AS value,
               unnest(list_reverse(embedding)) AS reversed
        FROM embeddings) t
""")
def zip_arrays(spark, d):
    emb = table(spark, d, "embeddings").withColumn("back", F.reverse("embedding"))
    rows = zip_checked(emb, ["vec_id"], {"value": "embedding", "reversed": "back"})
    return rows.select("vec_id", F.col("pos").cast("int").alias("pos"),
                       *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("value", "reversed")])


# Stored documents for the insert stand-ins: the English ones are already in the store.
def _stored_hashes(docs):
    return docs.filter(F.col("lang") == "en").select(content_hash(docs, ["text"]).alias("content_hash"))


@register("insert_if_absent", """
    WITH firsts AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text)
    SELECT f.doc_id, d.n_chars FROM firsts f JOIN documents d ON d.doc_id = f.doc_id
    WHERE f.text NOT IN (SELECT text FROM documents WHERE lang = 'en')
""")
def q_insert_if_absent(spark, d):
    docs = table(spark, d, "documents")
    out = insert_if_absent(docs.select("doc_id", "text", "n_chars"), _stored_hashes(docs), "doc_id", ["text"])
    return out.select("doc_id", "n_chars")


@register("early_stop_insert", """
    WITH m AS (
        SELECT doc_id, source,
               (text IN (SELECT text FROM documents WHERE lang = 'en'))
               OR doc_id > min(doc_id) OVER (PARTITION BY source, text) AS is_hit
        FROM documents),
    c AS (
        SELECT *, coalesce(sum(CAST(is_hit AS INTEGER)) OVER (
            PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hits_before
        FROM m),
    s AS (SELECT source, min(doc_id) AS stop_pos FROM c WHERE is_hit AND hits_before >= 5 GROUP BY source)
    SELECT c.doc_id, c.source FROM c LEFT JOIN s ON c.source = s.source
    WHERE NOT c.is_hit AND (s.stop_pos IS NULL OR c.doc_id < s.stop_pos)
""")
def early_stop_insert(spark, d):
    docs = table(spark, d, "documents")
    flags = early_stop_flags(docs.select("doc_id", "source", "text"), _stored_hashes(docs),
                             "source", "doc_id", ["text"], max_hits=5)
    return flags.filter("inserted").select("doc_id", "source")


# The sequential loop, one document a step: files by name, what a file inserts is seen by all later ones; Spanish texts are stored.
@register("early_stop_across_files", """
    WITH RECURSIVE d AS (
        SELECT row_number() OVER (ORDER BY source, doc_id) AS i, doc_id, source, md5(text) AS h,
               text IN (SELECT text FROM documents WHERE lang = 'es') AS known
        FROM documents),
    step AS (
        SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS doc_id, CAST('' AS VARCHAR) AS source, FALSE AS inserted,
               CAST(0 AS BIGINT) AS hits, FALSE AS ended, CAST([] AS VARCHAR[]) AS seen
        UNION ALL
        SELECT i, doc_id, source, NOT hit AND NOT over AS inserted, before + CAST(hit AND NOT over AS BIGINT) AS hits,
               over AS ended, CASE WHEN NOT hit AND NOT over THEN list_append(seen, h) ELSE seen END AS seen
        FROM (SELECT *, was_over OR (hit AND before >= 5) AS over
              FROM (SELECT d.*, step.seen, known OR list_contains(step.seen, d.h) AS hit,
                           CASE WHEN d.source = step.source THEN step.hits ELSE 0 END AS before,
                           d.source = step.source AND step.ended AS was_over
                    FROM step JOIN d ON d.i = step.i + 1)))
    SELECT source, doc_id, hits FROM step WHERE inserted
""")
def q_early_stop_across_files(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text", "lang")
    known = docs.filter("lang = 'es'").select(content_hash(docs, ["text"]).alias("content_hash"))
    flags = early_stop_across_files(docs, known, "source", "doc_id", ["text"], max_hits=5)
    return flags.filter("inserted").select("source", "doc_id", F.col("hits_before").alias("hits"))


# A third of the line items belong to key 0, which three partners share.
@register("join_hot_keys", """
    WITH b AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, l_quantity AS q FROM lineitem),
    o AS (SELECT s_suppkey AS o, s_nationkey AS n FROM supplier UNION ALL SELECT 0, n_nationkey FROM nation WHERE n_regionkey < 3)
    SELECT k, n, count(*) AS n_rows, round(sum(q), 2) AS quantity FROM b JOIN o ON k = o GROUP BY k, n
""")
def q_join_hot_keys(spark, d):
    """The hot key is found, its rows dealt over tasks, its partners replicated; all others join as they are."""
    li = table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).cast("long").alias("k"),
                                            F.col("l_quantity").alias("q"))
    partners = (table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("o"), F.col("s_nationkey").alias("n"))
                .unionByName(table(spark, d, "nation").filter("n_regionkey < 3").select((F.col("n_nationkey") % 1).cast("long").alias("o"), F.col("n_nationkey").alias("n"))))
    joined = join_hot_keys(li, partners, ["k"], ["o"], rows_a_task=2_000)
    return joined.groupBy("k", "n").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("q"), 2).alias("quantity"))


# Purchases with the user's latest view not after them, at most two days old.
@register("asof_weather", """
    SELECT p.event_id, CASE WHEN p.ts - v.ts <= INTERVAL 2 DAY THEN v.value END AS value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY user_id, ts) v
    ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def asof_weather(spark, d):
    """Views play the hourly forecasts, purchases the flights."""
    e = table(spark, d, "events")
    flights = e.filter("event_type = 'purchase'").select("event_id", F.col("user_id").alias("airport"), F.col("ts").alias("at"))
    weather = e.filter("event_type = 'view'").select("user_id", "ts", "value")
    joined = merge_flights_weather_hourly(flights, weather, "at", "ts", ["value"], "airport", "user_id", max_hours=48)
    return joined.select("event_id", "value")
