"""Distinct, duplicates, unions, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.operators.dedup import distinct_rows, keep_unique_keys, list_duplicates, union_pages, union_ragged
from delaykit.operators.joins import first_per_key
from delaykit.operators.ordering import top_n
from delaykit.registry.base import register, table


@register("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_distinct_rows(spark, d):
    return distinct_rows(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("keep_unique_keys", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (
        SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY 1 HAVING count(*) = 1)
""")
def q_keep_unique_keys(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return keep_unique_keys(li, ["l_orderkey", "l_linenumber"])


@register("list_duplicates", """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (
        SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY 1 HAVING count(*) > 1)
    ORDER BY l_linenumber, l_orderkey LIMIT 12
""")
def q_list_duplicates(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return list_duplicates(li, ["l_linenumber", "l_orderkey"], 12)


@register("union_pages", """
    SELECT doc_id, 'documents' AS origin, length(text) AS n_chars FROM documents
    UNION ALL
    SELECT item_id AS doc_id, 'benchmark' AS origin, length(text) AS n_chars FROM benchmark
""")
def q_union_pages(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lit("documents").alias("origin"),
                                               F.length("text").cast("long").alias("n_chars"))
    bench = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit("benchmark").alias("origin"),
                                                F.length("text").cast("long").alias("n_chars"))
    return union_pages(docs, bench)


@register("union_ragged", """
    SELECT doc_id, lang, CAST(NULL AS DOUBLE) AS quality FROM documents
    UNION ALL
    SELECT doc_id, NULL AS lang, CAST(quality AS DOUBLE) AS quality FROM labels
""")
def q_union_ragged(spark, d):
    # quality as double: an integer column holding NULLs converts the same way in every client
    return union_ragged(table(spark, d, "documents").select("doc_id", "lang"),
                        table(spark, d, "labels").select("doc_id", F.col("quality").cast("double")))


@register("top_n_two_keys", "SELECT * FROM orders ORDER BY o_orderdate, o_totalprice, o_orderkey LIMIT 12")
def top_n_two_keys(spark, d):
    return top_n(table(spark, d, "orders"), ["o_orderdate", "o_totalprice", "o_orderkey"], 12)


@register("limit_ordered", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_ordered(spark, d):
    return top_n(table(spark, d, "orders"), ["o_orderkey"], 5)


@register("first_match_per_key", """
    WITH firsts AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey)
    SELECT c.c_custkey, f.o_orderkey, o.o_orderdate
    FROM customer c LEFT JOIN firsts f ON c.c_custkey = f.o_custkey
    LEFT JOIN orders o ON o.o_orderkey = f.o_orderkey
""")
def first_match_per_key(spark, d):
    firsts = first_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], ["o_orderkey", "o_orderdate"])
    cust = table(spark, d, "customer").select("c_custkey")
    return (cust.join(firsts, cust.c_custkey == firsts.o_custkey, "left")
                .select("c_custkey", "o_orderkey", "o_orderdate"))
