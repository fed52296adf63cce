"""Query keys of the corpus operators: ``QUERIES`` and, where SQL can state the result, ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delaykit.llm.common import LOWER, UPPER, prepare_workers, table
from delaykit.llm.decontaminate import contamination
from delaykit.llm.embedding_dedup import near_vectors
from delaykit.llm.fim import fim_digest
from delaykit.llm.licenses import license_matches
from delaykit.llm.lm import scores
from delaykit.llm.packing import pack
from delaykit.llm.periodic import run_digest
from delaykit.llm.quality import quality
from delaykit.llm.simhash import near_duplicates
from delaykit.llm.suffix_dedup import remove_repeats
from delaykit.llm.toxicity import toxicity
from delaykit.llm.warc import capture_histories
from delaykit.llm.wrappers import extract

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


def _words_sql(column: str) -> str:
    return (rf"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op6_decontaminate", f"""
    WITH d AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words_sql('text')} AS w FROM benchmark),
    bn AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
    bs AS (SELECT item_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s FROM bn),
    bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM bs),
    ds AS (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s
           FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n),
    hit AS (SELECT doc_id, ds.n, s, item_id FROM ds JOIN bw
            ON ds.n = bw.n AND array_to_string(w[s:s + ds.n - 1], ' ') = bw.win),
    cov AS (SELECT doc_id, count(DISTINCT word_at) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS word_at FROM hit) GROUP BY doc_id),
    its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
""")
def op6_decontaminate(spark, d):
    return contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op10_simhash")
def op10_simhash(spark, d):
    return near_duplicates(table(spark, d, "documents"))


@query("op8_packing")
def op8_packing(spark, d):
    return pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_warc")
def op9_warc(spark, d):
    return capture_histories(table(spark, d, "pages"))


@query("op1_quality")
def op1_quality(spark, d):
    return quality(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op2_toxicity")
def op2_toxicity(spark, d):
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op7_embedding_dedup")
def op7_embedding_dedup(spark, d):
    return near_vectors(table(spark, d, "embeddings"))


@query("op4_language_model")
def op4_language_model(spark, d):
    return scores(table(spark, d, "documents"))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, d):
    return remove_repeats(table(spark, d, "documents"))


@query("op3_license_scan")
def op3_license_scan(spark, d):
    return license_matches(table(spark, d, "documents"))


@query("op11_fill_in_middle", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s,
                      regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
               FROM documents),
    h AS (SELECT *, len(u) AS n, CAST('0x' || substr(s, 1, 8) AS UBIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS UBIGINT) AS h2,
                 CAST('0x' || substr(s, 17, 8) AS UBIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS UBIGINT) AS h4 FROM d),
    c AS (SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
                 array_to_string(u[b + 1:n], '') AS suf FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
""")
def op11_fill_in_middle(spark, d):
    return fim_digest(table(spark, d, "documents"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, d):
    return run_digest(table(spark, d, "documents"))


@query("op12_html_text")
def op12_html_text(spark, d):
    return extract(table(spark, d, "pages"))
