"""Corpus pipeline over the table ``documents``: toxic documents go, one of each group of near copies stays, repeated
passages are cut out, contaminated documents go, and what is left is packed into sequences.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of ``documents`` (doc_id, text,
lang, source, n_chars).  Each stage judges just the rows and texts it is given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from delaykit.llm.common import crc_mod, prepare_workers, row_key, table
from delaykit.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # the stages' models, tokenizer and fingerprints have no SQL form; tests hold them against brute force


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below a half; the model is fitted on the given rows that have labels and
    whose crc32 of the id modulo 5 isn't 0."""
    prepare_workers(spark)
    learn = crc_mod("doc_id", 5) != 0
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), learn)
    scored = toxicity.scored(_columns(docs), model, prefix="__")
    return scored.filter(F.col("__score") < 0.5).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (3-word shingles, at most 3 differing bits): the one with the smallest id, of equal ids
    the one with the smallest key of its text; documents without an id come after all others of their group.  Rows are
    told apart by id and text, so different texts of one id are judged apart; of equal rows one stays."""
    prepare_workers(spark)
    chosen = materialize(simhash.representatives(docs, shingle=3, radius=3), "representatives")
    keyed = _columns(docs).withColumn("rk", row_key())
    stays = keyed.alias("d").join(chosen.alias("c"), F.expr("d.doc_id <=> c.doc_id AND d.rk = c.rk"))
    once = stays.filter("copies = 1").select(*[f"d.{c}" for c in COLUMNS])
    repeated = stays.filter("copies > 1").select("d.*").dropDuplicates(["doc_id", "rk"]).select(*COLUMNS)
    return once.unionByName(repeated)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text without the bytes of 100-byte strings that also start earlier; a character cut in part goes whole.  Null
    texts stay null; ``n_chars`` is counted anew."""
    prepare_workers(spark)
    docs = _columns(docs).withColumn("rk", row_key())
    cut = suffix_dedup.remove_repeats(docs, with_text=True).filter("n_removed > 0").select("doc_id", "rk", "kept").dropDuplicates(["doc_id", "rk"])
    joined = docs.alias("d").join(cut.alias("c"), F.expr("d.doc_id <=> c.doc_id AND d.rk = c.rk"), "left")
    kept = F.when(F.col("kept").isNull(), F.col("d.text")).otherwise(_valid_utf8(F.col("kept")))
    return joined.select("d.doc_id", kept.alias("text"), "d.lang", "d.source").withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _valid_utf8(data):
    """Bytes as text without the remains of cut characters (decoded as the replacement character)."""
    text = F.make_valid_utf8(data.cast("string"))
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(F.replace(text, F.lit("�"), F.lit("")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no more with the benchmark than the operator allows."""
    docs = _columns(docs)
    bad = (decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep_row_key=True)
           .filter("contaminated").select("doc_id", "rk").distinct())
    keyed = docs.withColumn("rk", row_key())
    return keyed.alias("d").join(bad.alias("b"), F.expr("d.doc_id <=> b.doc_id AND d.rk = b.rk"), "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    prepare_workers(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("repeats", cut_repeats),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
