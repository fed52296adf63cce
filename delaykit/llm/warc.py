"""WARC archives of pages and their external index merge.

Records are laid out in columns and written by Spark's text sink, whose record separator is the pair of line ends that
closes a WARC record, so every part file is a plain ``.warc``-format file in shared storage.  Reading back, each file
is parsed by its ``Content-Length`` headers into captures sorted by URL key and time: a sorted run.  The runs are dealt
by ranges of (URL key, time, page), so a URL with very many captures is cut by time, and in each range a loser tree
merges the runs: ranges and places in them give the global order of the capture histories.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.llm.common import broadcast_if_within
from delaykit.session import materialize, scratch_path

MIN_REVISIT, PER_FILE, BROADCAST_ROWS = 1000, 2000, 200_000
FILE_BYTES, HEADER_BYTES = 128 << 20, 2048  # of an archive, unless one record is larger; of a record besides its payload and URL
PER_RANGE = 100_000  # captures that a task merges, about
EPOCH = 1_704_067_200  # 2024-01-01T00:00:00Z; captures are one second apart in page order
SEPARATOR = "\r\n\r\n"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Adds ``payload``, ``payload_bytes``, ``payload_digest`` and ``refers_to``: of the pages with equal payloads of at
    least ``min_bytes`` the one with the largest id is kept, the others point at it."""
    p = (pages.withColumn("payload", F.coalesce("html", F.lit("")))
         .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
         .withColumn("payload_digest", F.sha1(F.col("payload").cast("binary"))))
    groups = (p.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return (p.join(broadcast_if_within(materialize(groups, "copies"), BROADCAST_ROWS),
                   ["payload_digest", "payload_bytes"], "left")
            .withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last")))
            .drop("last"))


def _line(name: str, value) -> F.Column:
    """A header line; none for a null value.  Line ends in a value would end the header and are taken out."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]", "")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def record_text() -> F.Column:
    """The record of a row of ``with_revisits`` without its closing line ends."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _line("Content-Length", F.col("payload_bytes")), F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    seen = F.coalesce("page_id", F.lit(0)) + EPOCH
    name = lambda page: F.concat(F.lit("<urn:md5:"), F.md5(page.cast("string").cast("binary")), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", name(F.coalesce("page_id", F.lit(-1)))),
        _line("WARC-Date", F.date_format(F.timestamp_seconds(seen), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", F.col("url")), _line("X-Page-Id", F.col("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(revisit, name(F.col("refers_to")))), _line("X-Refers-To-Page", F.col("refers_to")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)), F.lit("\r\n"), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT, per_file: int = PER_FILE,
                   file_bytes: int = FILE_BYTES) -> None:
    """Writes a folder of archives of at most ``per_file`` records and ``file_bytes`` (a larger record stands alone).

    Records are written by classes of size: those of class k have at most ``file_bytes / per_file * 2**k`` bytes, of which
    ``per_file / 2**k`` go to a file.  Most corpora have one class; each costs a scan of the pages."""
    size = sum((F.octet_length(F.coalesce(c, F.lit(""))) for c in ("html", "url")), F.lit(HEADER_BYTES))
    step = F.greatest(F.lit(0), F.ceil(F.log2(size * (per_file / file_bytes)))).cast("int")
    classes = sorted(r.k for r in pages.select(step.alias("k")).distinct().collect())  # at most 31
    rows = with_revisits(pages, min_bytes)
    for k in classes or [0]:
        (rows.filter(step == k).select(record_text().alias("value")).write.mode("append")
         .option("lineSep", SEPARATOR).option("maxRecordsPerFile", max(1, per_file >> k)).text(path))


def url_key(url: str | None) -> str:
    """Host labels reversed, then the path and query: ``com,example)/a?b``; port 80/443, ``www`` and fragments go."""
    rest = (url or "").split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].lower()
    host, _, port = host.partition(":")
    labels = host.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + (f":{port}" if port not in ("", "80", "443") else "") + ")/" + path


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if content[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} isn't closed")
        yield at, stop + 4 - at, headers, content[start:stop]
        at = stop + 4


_CAPTURES = ("url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string, "
             "record_type string, refers_to long, archive string, offset long, length long")


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _CAPTURES.split(", ")]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = []
            for offset, length, h, block in records(content):
                head, _, payload = block.partition(b"\r\n\r\n")
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                if h["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{path}, byte {offset}: the payload doesn't match its digest")
                size = next(int(x.split(b": ")[1]) for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))
                number = lambda key: int(h[key]) if key in h else None
                rows.append((url_key(h.get("WARC-Target-URI")), h["WARC-Date"], number("X-Page-Id"), size, digest,
                             h["WARC-Type"], number("X-Refers-To-Page"), path.rsplit("/", 1)[-1], offset, length))
            out = pd.DataFrame(sorted(rows, key=_order), columns=names)
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def _order(row: tuple) -> tuple:
    """URL key, time, page (null first), then the place in the archives."""
    return row[0], row[1], -1 if pd.isna(row[2]) else row[2], row[7], row[8]


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under ``path``; those of one archive stand together in sorted order."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_parse, _CAPTURES)


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of their match, so a new head is compared once a level."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))]
        self.losers = [-1] * self.k
        for i in range(len(runs)):
            self._play(i, building=True)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (_order(row), i, row)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _play(self, i: int, building: bool = False) -> None:
        node = (i + self.k) // 2
        while node > 0:
            if self.losers[node] < 0 and building:
                self.losers[node] = i
                return
            if self._less(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.heads and self.heads[w := self.losers[0]] is not None:
            yield self.heads[w][2]
            self.heads[w] = self._next(w)
            self._play(w)


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    runs: dict[str, list[list[tuple]]] = {}
    names = None
    for batch in batches:
        names = list(batch.columns)
        for row in batch.itertuples(index=False, name=None):
            own = runs.setdefault(row[7], [[]])
            if own[-1] and _order(row) < _order(own[-1][-1]):  # an archive's rows came in several sorted parts
                own.append([])
            own[-1].append(row)
    if not runs:
        return
    out = pd.DataFrame(list(LoserTree([run for k in sorted(runs) for run in runs[k]])), columns=names)
    out["place"] = range(len(out))
    yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def merged_index(captures: DataFrame) -> DataFrame:
    """The captures (a written table) with ``shard`` and ``place``: read by shard, then place, they are in global order.

    The number of ranges grows with the captures and every key is unique, so a task merges about ``PER_RANGE`` of them
    however often a URL was captured."""
    ranged = captures.repartitionByRange(1 + captures.count() // PER_RANGE, "url_key", "captured_at", "page_id", "archive", "offset")
    return ranged.mapInPandas(_merge, _CAPTURES + ", place long").withColumn("shard", F.spark_partition_id())


def capture_histories(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_REVISIT,
                      per_file: int = PER_FILE) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives under ``path`` (default: a new folder in the shared checkpoint
    location), reads them back and merges their indexes: one row per page with ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``, ``url_key``, ``captured_at``, ``archive``, ``offset``, ``length``,
    ``shard``, ``place``.

    Null html is an empty payload; a null URL has an empty key; a null id is older than any other; of equal pages with
    equal ids every one is a response; repeated rows are records of their own; extra columns are ignored.  Very long pages
    share an archive with few others or none."""
    spark = pages.sparkSession
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                         pages["html"].cast("string").alias("html"))
    path = path or scratch_path(spark, f"delaykit-warc-{uuid.uuid4().hex}")
    write_archives(pages, path, min_bytes, per_file)
    return merged_index(materialize(read_captures(spark, path), "captures"))
