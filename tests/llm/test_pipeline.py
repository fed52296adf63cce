"""The pipeline's stages, each on its own input, against plain statements of what they do."""

import pytest

import corpus_pipeline as P
from conftest import SF_SMALL
from delaykit.llm.decontaminate import contamination
from delaykit.llm.simhash import near_duplicates
from delaykit.llm.suffix_dedup import remove_repeats


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "A text of its own " * 3, "en", "s", 1, 5), (2, None, "en", "s", 0, 5), (3, "", None, None, 0, 5),
            (None, "no id", "en", "s", 5, 5), (None, "no id", "en", "s", 5, 5), (4, "é" * 120, "fr", "s", 120, 5),
            (5, "x" + "é" * 120, "fr", "s", 121, 5), (6, "A text of its own " * 3, "en", "t", 1, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp int")


def test_columns_and_kept_rows(spark, docs):
    near = P.drop_near_copies(spark, docs, SF_SMALL)
    assert near.columns == P.COLUMNS
    ids = sorted((r.doc_id for r in near.collect()), key=str)
    assert ids.count(None) == 1 and 6 not in ids and 1 in ids
    groups = {r.component_id for r in near_duplicates(docs).collect() if r.doc_id is not None}
    assert {i for i in ids if i is not None} == groups


def test_texts_of_one_id_are_judged_apart(spark):
    a, b = "alpha beta gamma delta " * 4, "quite another text that nobody copied here " * 2
    rows = [(1, a, 1), (1, b, 2), (2, b, 3), (2, b, 3), (None, a, 4), (None, "nameless words on their own", 5), (3, "", 6), (None, None, 7)]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for i, t, n in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in P.drop_near_copies(spark, docs, SF_SMALL).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (None, "nameless words on their own"), (3, "")], key=str)
    # near copies without an id go too: one word of many differs
    words = [f"w{k}" for k in range(400)]
    docs = spark.createDataFrame([(None, " ".join(words), "en", "s", 1), (None, " ".join([*words[:-1], "z"]), "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    near = len({r.fingerprint for r in near_duplicates(docs).collect()})
    bits = [int(r.fingerprint, 16) for r in near_duplicates(docs).collect()]
    assert P.drop_near_copies(spark, docs, SF_SMALL).count() == (1 if near == 1 or bin(bits[0] ^ bits[1]).count("1") <= 3 else 2)


def test_cut_texts(spark, docs):
    out = {r.doc_id: r for r in P.cut_repeats(spark, docs, SF_SMALL).filter("doc_id IS NOT NULL").collect()}
    assert out[5].text == "x" and out[5].n_chars == 1 and out[2].text is None and out[1].n_chars == 54
    removed = {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()}
    assert removed[5] == 240


def test_contaminated_go(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bad = {r.doc_id for r in contamination(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).filter("contaminated").collect()}
    kept = {r.doc_id for r in P.drop_contaminated(spark, docs, SF_SMALL).collect()}
    assert bad and kept == {r.doc_id for r in docs.collect()} - bad


def test_run(spark):
    out = P.run(spark, SF_SMALL)
    fill = out.groupBy("sequence_id").sum("length").collect()
    assert out.count() > 0 and all(r[1] <= 1024 for r in fill)


def test_empty(spark, docs):
    rows = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, rows, SF_SMALL).collect() == []
