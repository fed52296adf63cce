"""Large landed files split inside (S1, S16): the pages of one pretty-printed file are found by many tasks.

A JSON string holds no line end, so each line of a pretty-printed file tells by itself how many brackets it opens and closes.
Spark's text source splits a large file by bytes; a task cuts the lines of its splits into pieces and counts the brackets of each
once.  Sums over the pieces of a file (one row a piece) tell the depth at which a piece begins, so every line's depth is known
without sorting lines, and the lines of depth two in the member ``data`` begin the pages.  No task reads more than a split;
only pages that go on in another piece are grouped, all others are cut out of the piece that holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaykit import schemas
from delaykit.operators.documents import variant_path
from delaykit.session import materialize, workers_find_package
from delaykit.sources.files import document_schema

_STRING = r'"(?:[^"\\]|\\.)*"'
SMALL, LINES = 4 << 20, 10_000  # bytes of a file that is read as one row; lines of its pieces
_STEP = np.zeros(256, np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1

# A piece: lines of a split that follow each other.  ``steps`` and ``closes`` tell of each line how many more brackets it opens
# than it closes, and whether it begins with a closing one; ``levels`` count by depth (from that at which the piece begins) the
# lines that don't, and tell whether one begins with a brace.
_PIECES = ("piece long, file_path string, block long, n long, opened long, lowest long, last string, "
           "levels array<struct<depth:long,begins:long,brace:boolean>>, steps binary, closes binary, text string")
# A run of lines of a piece that belong to the same member and element.  ``head`` is its first line if that begins a member;
# ``begins``: its first line begins an element; ``whole``: that element ends with the run.
_RUNS = ("piece long, pos int, file_path string, block long, member long, element long, in_page boolean, begins boolean, "
         "whole boolean, head string, text string")
_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
          "array<struct<depth:long,begins:long,brace:boolean>>": pa.list_(pa.struct(
              [("depth", pa.int64()), ("begins", pa.int64()), ("brace", pa.bool_())]))}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in ddl.split(", ")))
    columns = list(zip(*rows)) if rows else [()] * len(names)
    # Texts are bytes here: a landed file needn't be UTF-8.
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()).view(pa.string()) if k == "string" else pa.array(c, _ARROW[k])
                                       for c, k in zip(columns, kinds)], names=list(names))


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each begins (and the last ends)."""
    wide = values.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if data else np.zeros(0, np.uint8), offsets - offsets[0]


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each, and of all."""
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def _steps(lines: pa.Array) -> np.ndarray:
    """Of each line how many more brackets it opens than it closes, outside of strings."""
    plain = ~pc.match_substring(lines, "\\").to_numpy(zero_copy_only=False)
    plain &= pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2 == 0
    steps = np.zeros(len(lines), np.int64)
    # Every other quote ends a string, and no string goes on in the next line.
    data, ends = _bytes_of(lines.filter(pa.array(plain)))
    outside = np.cumsum(data == ord('"'), dtype=np.uint8) & 1 == 0
    steps[plain] = np.diff(_sums(_STEP[data] * outside)[ends])
    data, ends = _bytes_of(pc.replace_substring_regex(lines.filter(pa.array(~plain)), _STRING, '""'))
    steps[~plain] = np.diff(_sums(_STEP[data])[ends])
    return steps


def _rows(piece: int, lines: pa.Array, cuts: list[tuple[int, int, bytes, int]]) -> list[tuple]:
    """Pieces, numbered from ``piece`` on, of lines that aren't blank, cut at (begin, end, file, split)."""
    data, ends = _bytes_of(pc.ascii_ltrim(lines, " "))
    first = data[ends[:-1]]
    closes, brace = (first == ord("]")) | (first == ord("}")), first == ord("{")
    lines = lines.cast(pa.binary())
    steps, out = _steps(lines), []
    for lo, hi, path, block in cuts:
        depth = _sums(steps[lo:hi])
        lowest = int(depth[:-1].min())
        place = depth[:-1] - lowest
        begins = np.bincount(place, ~closes[lo:hi])
        braces = np.bincount(place, brace[lo:hi]) > 0
        levels = [{"depth": d + lowest, "begins": int(begins[d]), "brace": bool(braces[d])}
                  for d in np.flatnonzero((begins > 0) | braces).tolist()]
        own = lines.slice(lo, hi - lo)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), own), b"\n")[0].as_py()
        out.append((piece + len(out), path, block, hi - lo, int(depth[-1]), lowest, lines[hi - 1].as_py(), levels,
                    steps[lo:hi].astype(np.int32).tobytes(), closes[lo:hi].tobytes(), text))
    return out


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of rows of a line: the lines of a batch in one split."""
    piece = TaskContext.get().partitionId() << 33
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, blocks = batch.column(0).cast(pa.binary()), batch.column(1).to_numpy()
        other = pc.not_equal(paths.slice(1), paths.slice(0, len(paths) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(other | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(blocks)]
        out = _rows(piece, batch.column(2), [(lo, hi, paths[lo].as_py(), int(blocks[lo])) for lo, hi in zip(cuts, cuts[1:])])
        piece += len(out)
        yield _batch(out, _PIECES)


def _cut_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of rows of a whole file, whose lines end as the text source has it."""
    piece = TaskContext.get().partitionId() << 33
    for batch in batches:
        paths, texts = batch.column(0).cast(pa.binary()), batch.column(1).cast(pa.binary())
        for i in range(batch.num_rows):
            text = texts[i].as_py().removeprefix(b"\xef\xbb\xbf")
            if b"\r" in text:
                text = text.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            lines = pc.split_pattern(pa.array([text], pa.binary()), "\n").flatten().view(pa.string())
            lines = lines.filter(pc.greater(pc.binary_length(pc.ascii_ltrim(lines, " ")), 0))
            if len(lines):
                out = _rows(piece, lines, [(lo, min(lo + LINES, len(lines)), paths[i].as_py(), 0) for lo in range(0, len(lines), LINES)])
                piece += len(out)
                yield _batch(out, _PIECES)


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the lines of pieces, but the lines of depth one that close."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        paths = batch.column(batch.schema.get_field_index("file_path")).cast(pa.binary())
        for i, r in enumerate(batch.drop_columns(["text", "file_path"]).to_pylist()):
            text, path = texts[i].as_py(), paths[i].as_py()
            steps, closes = np.frombuffer(r["steps"], np.int32), np.frombuffer(r["closes"], bool)
            depth = r["depth"] + _sums(steps)[:-1]
            begins_member, begins = ~closes & (depth == 1), ~closes & (depth == 2)
            member, element = r["members"] + np.cumsum(begins_member), r["elements"] + np.cumsum(begins)
            kind = np.where((depth == 1) & closes, 2, (depth >= 2) & ~((depth == 2) & closes))
            cuts = np.flatnonzero(np.concatenate([[True], begins_member[1:] | begins[1:] | (kind[1:] != kind[:-1])]))
            line_ends = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), len(text))
            starts = np.concatenate([[0], line_ends[:-1] + 1])
            last = np.append(cuts[1:], len(steps)) - 1
            whole = begins[cuts] & np.append(begins[cuts[1:]], False)
            columns = [cuts, starts[cuts], line_ends[cuts], line_ends[last], member[cuts], element[cuts], kind[cuts], begins[cuts],
                       whole, begins_member[cuts]]
            yield _batch([(r["piece"], pos, path, r["block"], m, e, k == 1, b, w, text[start:end] if head else None, text[start:stop])
                          for pos, start, end, stop, m, e, k, b, w, head in zip(*(c.tolist() for c in columns)) if k != 2], _RUNS)


def _pieces(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    workers_find_package(spark)
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    name, small = F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size") <= SMALL
    # The size is known before a file is opened, so each is read by one of the two.  Rows of a line cost far more than the line.
    whole = reader.text(path, wholetext=True).filter(small).select(name, "value")
    lines = (reader.text(path).filter(~small).filter(F.trim("value") != "")
             .select(name, F.col("_metadata.file_block_start").alias("block"), "value"))
    return materialize(whole.mapInArrow(_cut_files, _PIECES).unionByName(lines.mapInArrow(_cut_pieces, _PIECES)), "pieces")


def _placed(pieces: DataFrame) -> DataFrame:
    """The pieces without their lines, with the depth, the members of the root and the elements of members before them."""
    before = Window.partitionBy("file_path").orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    begins = lambda depth: F.aggregate(F.filter("levels", lambda x: x["depth"] == depth - F.col("depth")), F.lit(0).cast("long"),
                                       lambda a, x: a + x["begins"])
    return (pieces.drop("steps", "closes", "text").withColumn("depth", so_far("opened"))
            .withColumns({"members": begins(1), "elements": begins(2),
                          "is_object": F.exists("levels", lambda x: (x["depth"] == -F.col("depth")) & x["brace"])})
            .withColumns({"members": so_far("members"), "elements": so_far("elements")}).drop("levels"))


_ORDER = ("block", "piece", "pos")


def _text() -> Column:
    """The runs of a group in their order, without the comma that follows the last."""
    rows = F.array_sort(F.collect_list(F.struct(*_ORDER, "text")))
    return _without_comma(F.array_join(F.transform(rows, lambda r: r["text"]), "\n"))


def _without_comma(text) -> Column:
    return F.regexp_replace(text, r",\s*$", "")


def split_documents(spark: SparkSession, path: str, glob: str | None = "*.json") -> tuple[DataFrame, DataFrame]:
    """(pages, unreadable files) of landed files, ``{"metadata": {..}, "data": [page, ..]}`` with a line for each bracket, as
    ``json.dump(.., indent=..)`` writes them; a file that stands on one line is read as one row.

    Pages have ``file_path``, ``metadata`` (text), ``page_pos`` and ``page_text``.  A file whose brackets don't add up is
    unreadable (``file_path``, ``reason``, ``record``: its last line) and gives no pages; of files laid out in other ways
    (two pages sharing a line) the pages that can't be parsed are listed by ``sources.files.unreadable_pages``."""
    pieces = _pieces(spark, path, glob)
    placed = materialize(_placed(pieces), "placed")
    files = placed.groupBy("file_path").agg(
        F.sum("opened").alias("left_open"), F.min(F.col("depth") + F.col("lowest")).alias("lowest"), F.sum("n").alias("n"),
        F.max_by("last", F.struct("block", "piece")).alias("last"), F.max("is_object").alias("is_object"))
    sound = (F.col("left_open") == 0) & (F.col("lowest") >= 0) & F.coalesce("is_object", F.lit(False))
    bad = files.filter(~sound).select("file_path", F.lit("unreadable").alias("reason"), F.col("last").alias("record"))
    good = files.filter(sound).select("file_path", "n")

    # Written first, as Spark then knows that a table of a row a piece or file is small, and doesn't shuffle texts to join it.
    places = materialize(placed.join(good.filter("n > 1").select("file_path"), "file_path")
                         .select("piece", "depth", "members", "elements"), "places")
    runs = materialize(pieces.select("piece", "file_path", "block", "steps", "closes", "text").join(places, "piece")
                       .mapInArrow(_cut_runs, _RUNS), "runs")
    names = materialize(runs.filter("head IS NOT NULL").select(
        "file_path", "member", F.regexp_extract("head", r'^\s*"((?:[^"\\]|\\.)*)"\s*:', 1).alias("name")), "names")
    of = lambda name: runs.join(names.filter(F.col("name") == name).select("file_path", "member"), ["file_path", "member"])
    metadata = of("metadata").groupBy("file_path").agg(_text().alias("member")).select(
        "file_path", F.regexp_replace("member", r'^\s*"metadata"\s*:\s*', "").alias("metadata"))
    first = of("data").filter("begins").groupBy("file_path").agg(F.min("element").alias("first"))
    heads = materialize(first.join(metadata, "file_path", "left"), "heads")
    found = of("data").filter("in_page")
    pages = (found.filter("whole").select("file_path", "element", _without_comma("text").alias("page_text"))
             .unionByName(found.filter("NOT whole").groupBy("file_path", "element").agg(_text().alias("page_text"))))
    spread = pages.join(heads, "file_path").select(
        "file_path", "metadata", (F.col("element") - F.col("first")).cast("int").alias("page_pos"), "page_text")
    one = F.from_json("value", document_schema().simpleString(), {"columnNameOfCorruptRecord": "_corrupt_record"})
    short = (pieces.filter("n = 1").select("file_path", F.col("text").alias("value"))
             .join(good.filter("n = 1").select("file_path"), "file_path").withColumn("doc", one)
             .select("file_path", F.col("doc.metadata").alias("metadata"), F.posexplode("doc.data").alias("page_pos", "page_text")))
    return spread.unionByName(short), bad


def split_pages(pages: DataFrame, api_name: str = "flightstatus") -> DataFrame:
    """``page`` (VARIANT, the container's content) beside ``page_text``, as ``operators.documents.pages_of_documents`` gives."""
    container = variant_path((schemas.container_for(api_name),))
    return pages.withColumn("page", F.try_variant_get(F.try_parse_json("page_text"), container, "variant"))
