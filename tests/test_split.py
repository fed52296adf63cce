"""One large landed file is read by several tasks, and gives what the plain read gives."""

import json
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from delaykit.operators.documents import pages_of_documents
from delaykit.registry import QUERIES
from delaykit.sources import split
from delaykit.sources.files import read_documents, unreadable_pages
from delaykit.sources.split import split_documents, split_pages


def _page(i):
    tricky = 'quotes " and \\ and {[ ]} , "data": [' if i % 97 == 0 else "plain"
    return {"FlightStatusResource": {"Flights": {"Flight": [{"No": str(i), "Text": tricky, "Codes": [], "Extra": {}}] * (i % 3)},
                                     "Meta": {"TotalCount": i, "data": [1, 2]}}}


def _file(pages, **more):
    return {"metadata": {"start_range": "2024-09-06T00:00", "data": ["x"]}, "data": pages, **more}


def _plain(spark, folder):
    rows = pages_of_documents(read_documents(spark, folder), keep=["file_path", "metadata"])
    return {(r.file_path.rsplit("/", 1)[-1], r.page_pos): (r.p, json.loads(r.metadata)) for r in
            rows.select("file_path", "metadata", "page_pos", F.to_json("page").alias("p")).collect()}


def _split(spark, folder):
    rows, bad = split_documents(spark, folder)
    got = split_pages(rows).select("file_path", "metadata", "page_pos", F.to_json("page").alias("p")).collect()
    assert len(got) == len({(r.file_path, r.page_pos) for r in got})
    return ({(r.file_path.rsplit("/", 1)[-1], r.page_pos): (r.p, json.loads(r.metadata)) for r in got},
            {r.file_path.rsplit("/", 1)[-1] for r in bad.collect()})


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "large.json").write_text(json.dumps(_file([_page(i) for i in range(10_000)]), indent=4))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    try:
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
        got, bad = _split(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 8 and not bad and len(got) == 10_000
    assert got == _plain(spark, str(tmp_path))


def test_other_layouts(spark, tmp_path):
    docs = {"two.json": json.dumps(_file([_page(1), _page(2)]), indent=2), "line.json": json.dumps(_file([_page(3), _page(4)])),
            "none.json": json.dumps(_file([]), indent=4), "last.json": json.dumps({"data": [_page(5)], "metadata": {}}, indent=1),
            "more.json": json.dumps(_file([_page(6)], other=[[1], [2]]), indent=4).replace("\n", "\r\n"),
            "null.json": json.dumps(_file([None, _page(7), {}]), indent=4)}
    for name, text in docs.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "cut.json").write_text(docs["two.json"][:-40])
    (tmp_path / "broken.json").write_text("{ not json")
    (tmp_path / "empty.json").write_text("")
    got, bad = _split(spark, str(tmp_path))
    assert bad == {"cut.json", "broken.json"}
    assert got == {k: v for k, v in _plain(spark, str(tmp_path)).items() if k[0] not in bad}
    listed = unreadable_pages(split_pages(split_documents(spark, str(tmp_path))[0])).collect()
    assert sorted(r.reason for r in listed) == ["page 0", "page 2"]


@contextmanager
def _settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_written_tables_hold_no_row_for_every_line(spark, tmp_path, monkeypatch):
    pages = [_page(i) for i in range(1_000)]
    (tmp_path / "large.json").write_text(json.dumps(_file(pages), indent=4))
    written, write = [], split.materialize
    monkeypatch.setattr(split, "materialize", lambda df, *args, **more: written.append(write(df, *args, **more)) or written[-1])
    got, bad = _split(spark, str(tmp_path))
    assert len(got) == len(pages) and not bad
    assert max(df.count() for df in written) < 1.2 * len(pages)  # of about 25 lines each


@pytest.mark.parametrize("small", [0, 4 << 20])
def test_pages_go_on_in_other_pieces(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(split, "SMALL", small)
    text = json.dumps(_file([_page(i) for i in range(200)], other=[[1], {"a": [2]}]), indent=2)
    (tmp_path / "large.json").write_text(text)
    (tmp_path / "blank.json").write_text(text.replace("\n", "\n   \n\n"))
    (tmp_path / "mark.json").write_bytes(b"\xef\xbb\xbf" + text.replace("\n", "\r").encode())
    (tmp_path / "back.json").write_text(json.dumps(_file([{"a\\": '\\"[', 'b"': ["{\\", '"']}, {"é": "]\u2028"}]), indent=1, ensure_ascii=False))
    with _settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="7"):
        rows, bad = split_documents(spark, str(tmp_path))
        got = {(r.file_path.rsplit("/", 1)[-1], r.page_pos): (json.loads(r.page_text), json.loads(r.metadata)) for r in rows.collect()}
        assert bad.count() == 0
    want = {(p.name, i): (page, doc["metadata"]) for p in tmp_path.iterdir()
            for doc in [json.loads(p.read_text("utf-8-sig"))] for i, page in enumerate(doc["data"])}
    assert got == want


def test_a_file_is_landed_whole_from_many_partitions(spark, tmp_path):
    orders, n = 20_000, 3
    spark.range(orders).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(orders * n).select((F.col("id") % orders).alias("l_orderkey"), F.floor(F.col("id") / orders).alias("l_linenumber"),
                                   F.lit(2).cast("decimal(12,2)").alias("l_quantity")).write.parquet(str(tmp_path / "lineitem.parquet"))
    with _settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k", spark__sql__autoBroadcastJoinThreshold="100k"):
        got = {tuple(r) for r in QUERIES["split_landed_file"](spark, str(tmp_path)).collect()}
    assert got == {(k, 5_000, 4_999, 5_000 * n, 10_000.0 * n) for k in range(orders // 5_000)}
