"""Best-fit packing of tokenized documents by hierarchical residual packing.

Every input partition tokenizes its documents and packs the pieces best-fit, longest first.  Bins whose room no
other bin can use are final.  The underfull rest goes up a tree of ``fan_in`` partitions a node: there whole bins are
the items of another best-fit round.  After a round at most one bin of a node is half full or less (two such would
have been joined), so a node's children bring at most ``fan_in`` bins that can move; more than ``fan_in`` larger bins
of one fill can never be needed to take them, and only those go up.  A node's work is thus bounded by
``fan_in^2 * capacity`` bins at any input size, and no bin is lost by the bound.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import texts_of
from delaykit.session import materialize

CAPACITY, END_ID, FAN_IN, CACHE = 1024, 2, 16, 800_000
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]
LOOSE = [f" {c}" for c in WHITE] + [f"{c} " for c in WHITE]  # white space beside a space
# Fixed value: how byte-level vocabularies of this kind cut a text (public, part of their definition).
BYTE_LEVEL_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """Such vocabularies spell a byte as the character of its number where that is printable, others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    return dict(zip(shown, map(chr, shown))) | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(shown)))}


BYTE_LETTERS = _byte_letters()


class BestFit:
    """Bins of one capacity; the open bin with the least room that still holds an item takes it."""

    def __init__(self, capacity: int):
        self.capacity, self.fills, self.mask = capacity, [], 0
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, size: int) -> tuple[int, int]:
        """(bin, offset of the item in it)."""
        fitting = self.mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = self.by_room[room].pop()
            if not self.by_room[room]:
                self.mask &= ~(1 << room)
        else:
            room, bin_ = self.capacity, len(self.fills)
            self.fills.append(0)
        offset = self.fills[bin_]
        self.fills[bin_] += size
        if left := room - size:
            self.by_room[left].append(bin_)
            self.mask |= 1 << left
        return bin_, offset

    def pack(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of items, longest first."""
        bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for i in np.argsort(-sizes, kind="stable").tolist():
            bins[i], offsets[i] = self.add(int(sizes[i]))
        return bins, offsets

    def rising(self, fan_in: int) -> np.ndarray:
        """Which bins the next round needs: those at most half full, and ``fan_in`` of every other fill below capacity."""
        fills, up, seen = self.fills, np.zeros(len(self.fills), bool), {}
        for i, fill in enumerate(fills):
            seen[fill] = seen.get(fill, 0) + 1
            up[i] = 2 * fill <= self.capacity or fill < self.capacity and seen[fill] <= fan_in
        return up


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes, by the tokenizers library.

    A byte-level vocabulary never joins a single space to the non-space before it, so a text without white space beside a
    space is the sequence of its space-led chunks.  Their ids are kept from text to text, and those of the parts that the
    vocabulary's pre-tokenizer cuts new chunks into, each encoded by the vocabulary's model.  Any other text, and any other
    kind of vocabulary, goes through the library whole."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.size, self.chunks, self.parts = cache, {}, {}
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        before = kind.get("pre_tokenizer") or {}
        self.avoid = LOOSE + [t["content"] for t in kind.get("added_tokens", ())]
        self.byte_level = (before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                           and before.get("use_regex", True) and not kind.get("normalizer") and not kind.get("post_processor"))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _chunk(self, chunk: str) -> bytes:
        out, parts, model = [], self.parts, self.tokenizer.model
        for part in BYTE_LEVEL_PARTS.findall(chunk):
            ids = parts.get(part)
            if ids is None:
                spelled = part.encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)
                tokens = model.tokenize(spelled)
                ids = b"".join([t.id.to_bytes(4, "little") for t in tokens])
                if len(parts) < self.size:
                    parts[part] = ids
            out.append(ids)
        ids = b"".join(out)
        if len(self.chunks) < self.size:
            self.chunks[chunk] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        whole = []
        for k, text in enumerate(texts):
            if not self.byte_level or "\0" in text or text[:1] == " " or text[-1:] == " " or any(t in text for t in self.avoid):
                whole.append(k)
                continue
            chunks = text.replace(" ", "\0 ").split("\0")
            ids = list(map(self.chunks.get, chunks))
            if None in ids:
                ids = [self._chunk(c) if i is None else i for c, i in zip(chunks, ids)]
            out[k] = b"".join(ids)
        for k, ids in zip(whole, self._whole([texts[k] for k in whole])):
            out[k] = ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first, which may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long, "
           "rises boolean")


def _pack_partition(path: str, capacity: int, end_id: int, fan_in: int, keep_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, docs, kept = [], [], []
        for batch in batches:
            ids_of, texts = batch["doc_id"].tolist(), [t if t is not None else "" for t in batch["text"].tolist()]
            for lo in range(0, len(texts), 512):
                for doc, ids in zip(ids_of[lo:lo + 512], encoder(path).encode(texts[lo:lo + 512])):
                    ids += end
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * start:4 * (start + length)]
                        docs.append(doc)
                        rows.append((k, start, length, zlib.crc32(part)))
                        if keep_ids:
                            kept.append(part)
        if not rows:
            return
        table = np.array(rows, np.int64)
        fit = BestFit(capacity)
        bins, offsets = fit.pack(table[:, 2])
        fills, up = np.array(fit.fills), fit.rising(fan_in)
        base = np.int64(TaskContext.get().partitionId()) << np.int64(32)
        out = pd.DataFrame({"doc_id": pd.array(docs, dtype="Int64"), "piece": table[:, 0].astype(np.int32),
                            "start": table[:, 1], "length": table[:, 2], "ids_crc32": table[:, 3], "bin": base + bins,
                            "offset": offsets, "fill": fills[bins], "rises": up[bins]})
        if keep_ids:
            out["ids"] = [np.frombuffer(p, "<u4").astype(np.int64) for p in kept]
        for lo in range(0, len(out), 10_000):
            yield out.iloc[lo:lo + 10_000]
    return run


def _merge_nodes(capacity: int, fan_in: int, level: int):
    """Rows sorted by node: best-fit over each node's rising bins.  New bins are numbered by level and node."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]  # whole nodes, each bounded (see the module)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        for node, own in rows.groupby("node"):
            fit = BestFit(capacity)
            bins, offsets = fit.pack(own["fill"].to_numpy())
            fills, up = np.array(fit.fills), fit.rising(fan_in)
            base = (np.int64(level) << np.int64(56)) | (np.int64(node) << np.int64(32))
            yield pd.DataFrame({"bin": own["bin"].to_numpy(), "into": base + bins, "base": offsets,
                                "fill": fills[bins], "rises": up[bins]})
    return run


def pack(docs: DataFrame, vocab: str, capacity: int = CAPACITY, end_id: int = END_ID, fan_in: int = FAN_IN,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``
    and, with ``keep_ids``, the piece's token ``ids``.

    ``vocab``: path of the tokenizer file on every executor.  Null and empty texts are the end id alone; null ids and
    repeated rows are packed like any other; extra columns are ignored; an empty table gives no rows."""
    schema = _PIECES + (", ids array<long>" if keep_ids else "")
    pieces = materialize(texts_of(docs, id_col, text_col).mapInPandas(
        _pack_partition(vocab, capacity, end_id, fan_in, keep_ids), schema), "pieces")
    top = pieces.agg(F.max(F.shiftright("bin", 32))).first()[0] or 0
    rising = pieces.filter("rises AND offset = 0").select("bin", "fill", F.shiftright("bin", 32).alias("node"))
    moved, level = None, 0
    while top > 0:
        level, top = level + 1, top // fan_in
        nodes = rising.select("bin", "fill", F.floor(F.col("node") / fan_in).alias("node"))
        step = materialize(nodes.repartition("node").sortWithinPartitions("node", F.desc("fill"), "bin").mapInPandas(
            _merge_nodes(capacity, fan_in, level),
            "bin long, into long, base long, fill long, rises boolean"), "merge")
        rising = step.filter("rises AND base = 0").select(
            F.col("into").alias("bin"), "fill", F.shiftright(F.col("into").bitwiseAND(F.lit((1 << 56) - 1)), 32).alias("node"))
        links = step.select("bin", "into", "base")
        if moved is None:
            moved = links
        else:
            nxt = links.select(F.col("bin").alias("into"), F.col("into").alias("into2"), F.col("base").alias("base2"))
            moved = moved.join(nxt, "into", "left").select(
                "bin", F.coalesce("into2", "into").alias("into"),
                (F.col("base") + F.coalesce("base2", F.lit(0))).alias("base"))
    if moved is None:
        out = pieces.withColumn("into", F.col("bin")).withColumn("base", F.lit(0))
    else:
        out = pieces.join(moved, "bin", "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"),
                      (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"), *(["ids"] if keep_ids else []))

