"""Archives are bounded by bytes, and ranges of the merged index by captures."""

import os

from delaykit.llm import warc
from delaykit.llm.warc import capture_histories, write_archives

PAGES = [(i, f"http://h{i % 3}.example/p{i % 7}", f"<p>{i}</p>" + "x" * (300_000 if i % 50 == 0 else 40_000 if i % 10 == 1 else 900))
         for i in range(300)]


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    write_archives(pages, str(tmp_path / "w"), per_file=64, file_bytes=256 << 10)
    files = [tmp_path / "w" / f for f in os.listdir(tmp_path / "w") if f.startswith("part")]
    counts = [f.read_bytes().count(b"WARC/1.1\r\n") for f in files]
    assert sum(counts) == len(PAGES) and max(counts) > 20
    assert all(n == 1 or f.stat().st_size <= 256 << 10 for f, n in zip(files, counts))
    read = warc.read_captures(spark, str(tmp_path / "w")).collect()
    assert {(r.page_id, r.payload_bytes) for r in read} == {(i, len(h)) for i, _, h in PAGES}


def test_ranges_are_bounded_by_captures(spark, monkeypatch):
    monkeypatch.setattr(warc, "PER_RANGE", 40)
    rows = [(i, "http://hot.example/" if i % 3 else f"http://x{i}.example/", f"page {i}") for i in range(400)]
    got = capture_histories(spark.createDataFrame(rows, "page_id long, url string, html string"), per_file=30).collect()
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    assert len(shards) >= 8 and max(map(len, shards.values())) <= 160  # the hot URL is cut by time
    ordered = [r for k in sorted(shards) for r in sorted(shards[k], key=lambda r: r.place)]
    assert ordered == sorted(got, key=lambda r: (r.url_key, r.captured_at, r.page_id))
    assert len(got) == 400
