"""Removal of long repeated byte strings with run-length Burrows-Wheeler indexes.

A byte goes if it is covered by a string of ``length`` bytes that also starts earlier in the corpus (order: document id,
then place).  No index of the whole corpus is built; it is cut into pieces that can be indexed apart:

1. *Anchors.*  In every string of ``length`` bytes the k-gram with the smallest hash is its anchor.  Equal strings have
   equal anchors at equal places, so only places with the same anchor hash have to be compared.  The strings that share one
   occurrence of an anchor form a segment, of at most ``2 * length`` bytes.
2. Segments are sorted by anchor.  An anchor that occurs once is done.  Of segments with equal bytes all but the first are
   wholly repeated; most copies are settled so in the tasks that read them, before the shuffle.  What is left, the first ones of different segments with one anchor, is compared byte by byte.
3. *Index.*  The left segments of whole anchors, in blocks of bounded size, are joined to one text.  Its Burrows-Wheeler
   transform is kept as runs with the text position sampled at every run's end; neighbouring rows that agree in ``length``
   symbols form an interval.  All segments are streamed through the index from right to left by LF steps: each step gives
   the row of the suffix at that place, hence whether its match reaches ``length`` and with which interval; the first
   place of an interval stays, the others are marked.
4. An anchor with a crowd of different segments (a passage in a large share of the documents) isn't put in one task: its
   strings are dealt and compared by 128-bit hashes, in a grouped minimum and a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import broadcast_if_within, row_key, texts_of
from delaykit.session import materialize

LENGTH, GRAM = 100, 32
BLOCK, LARGEST = 3 << 18, 1 << 20  # bytes of segments that fill an index, and of one anchor's segments in an index
HELD, CROWDED, CROWDS_SENT = 200_000, 20_000, 200_000  # segments settled together in a task; members that make a crowd
_ODD, _SEED = 0x100000001B3, 0xBF58476D1CE4E5B9


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Mixed 64-bit hashes of all k-grams, put together from those of power-of-two lengths."""
    with np.errstate(over="ignore"):
        part, size, power = data.astype(np.uint64) + np.uint64(1), 1, np.uint64(_ODD)
        whole, done = None, 0
        while True:
            if k & size:
                if whole is None:
                    whole = part
                else:
                    n = len(part) - done
                    whole = whole[:n] * power + part[done:done + n]
                done += size
            if 2 * size > k:
                break
            n = len(part) - size
            part, size, power = part[:n] * power + part[size:size + n], 2 * size, power * power
        x = whole[:len(data) - k + 1]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(_SEED)
        return x ^ (x >> np.uint64(32))


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest of every ``w`` neighbours, the first of equal ones."""
    at, size = np.arange(len(x)), 1
    while size < w:
        step = min(size, w - size)
        later = x[step:] < x[:-step]
        x, at = np.where(later, x[step:], x[:-step]), np.where(later, at[step:], at[:-step])
        size += step
    return at


def segments(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, start, size): the runs of strings that share one occurrence of a smallest gram.  No string stands twice
    in a segment: its anchor would too."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    at = window_minima(hashes, length - gram + 1)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[starts, len(at)]) + length - 1
    return hashes[at[starts]].view(np.int64), starts, sizes


_ORDER = ["h", "s", "doc", "rk", "lo"]


def _anchors(length: int, gram: int, held: int):
    """The segments of a task's texts.  Of equal segments among ``held`` neighbouring ones all but the first are settled
    here (``again``), so copies don't meet in one reducer; ``k`` deals settled rows by place, others by anchor."""
    def settled(parts: list[tuple]) -> pd.DataFrame:
        h, s, doc, rk, lo, n = (np.concatenate(x) for x in zip(*parts))
        mixed = h ^ (s * np.int64(0x9E3779B97F4A7C1))
        order = np.argsort(mixed)
        alone = np.r_[True, np.diff(mixed[order]) != 0, True]
        few = order[~(alone[1:] & alone[:-1])]  # only segments that have an equal one need their places in order
        few = few[np.lexsort((lo[few], rk[few], doc[few], s[few], h[few]))]
        again, keep = np.zeros(len(h), bool), np.ones(len(h), bool)
        if len(few):
            a, b = few[:-1], few[1:]
            same = (h[a] == h[b]) & (s[a] == s[b])
            again[b] = same
            keep[b] = ~(same & (doc[a] == doc[b]) & (rk[a] == rk[b]) & (lo[a] == lo[b]))  # a repeated row of the input
        k = np.where(again, (doc ^ rk) + lo * np.int64(0x9E3779B97F4A7C1), h)
        return pd.DataFrame({"h": h[keep], "s": s[keep], "doc": doc[keep], "rk": rk[keep], "lo": lo[keep].astype(np.int32),
                             "n": n[keep].astype(np.int32), "again": again[keep], "k": k[keep]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part, docs, keys, found = batch.iloc[lo:lo + 64], [], [], []
                digests: list[int] = []
                for doc, rk, text in zip(part["doc"], part["rk"], part["text"]):
                    data = text.encode("utf-8", "surrogatepass")
                    h, starts, sizes = segments(data, length, gram)
                    found.append((h, starts, sizes))
                    docs.append(np.full(len(h), doc, np.int64))
                    keys.append(np.full(len(h), rk, np.int64))
                    digests += [xxhash.xxh64_intdigest(data[a:a + n]) for a, n in zip(starts.tolist(), sizes.tolist())]
                h, starts, sizes = (np.concatenate(x) for x in zip(*found))
                parts.append((h, np.array(digests, np.uint64).view(np.int64), np.concatenate(docs), np.concatenate(keys),
                              starts, sizes))
                size += len(h)
                if size >= held:
                    yield settled(parts)
                    parts, size = [], 0
        if size:
            yield settled(parts)
    return run


def _sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (k, h, s, place): repeats of a segment (``again``) and the first ones of anchors with several segments."""
    held, several, last, row = None, False, (None, None), None
    keys = _ORDER
    for batch in batches:
        if batch["again"].any():
            yield batch[batch["again"]]
            batch = batch[~batch["again"]]
        # A repeated row of the input brings its segments again: they are the same place, not a repeat.
        same = batch[keys].eq(batch[keys].shift()).all(axis=1).to_numpy()
        if len(batch) and row is not None:
            same[0] = tuple(batch[keys].iloc[0]) == row
        batch = batch[~same]
        if not len(batch):
            continue
        row = tuple(batch[keys].iloc[-1])
        h, s = batch["h"].to_numpy(), batch["s"].to_numpy()
        old_h = np.r_[h[0] == last[0] if last[0] is not None else False, h[1:] == h[:-1]]
        again = old_h & np.r_[s[0] == last[1] if last[1] is not None else False, s[1:] == s[:-1]]
        other = old_h & ~again  # another segment of the anchor before
        begins = np.flatnonzero(~old_h)
        group = np.cumsum(~old_h)  # 0: the group that the batch before began
        mixed = np.bincount(group[other], minlength=group[-1] + 1) > 0
        out = other.copy()
        out[begins] = mixed[1:]
        if held is not None and mixed[0] and not several:
            yield held.assign(again=False)
        part = batch[out | again]
        if len(part):
            yield part.assign(again=again[out | again])
        if len(begins):
            held, several = batch.iloc[begins[-1]:begins[-1] + 1], bool(mixed[-1])
        else:
            several = several or bool(mixed[0])
        last = (h[-1], s[-1])


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of texts, each closed by a mark of its own.  Bytes up to 254, as in UTF-8."""

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes + 1) - 1
        joined[self.ends] = 0
        self.n, self.sizes = len(joined), sizes
        rows, grams = self._suffixes(joined, length)
        before = np.r_[0, joined[:-1]][rows]  # a text's first suffix is preceded by a mark
        head = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.run_start, self.run_symbol = head, before[head]
        self.run_size = np.diff(np.r_[head, self.n])
        self.run_sample = rows[np.r_[head[1:], self.n] - 1]  # text position at each run's end
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        smaller = np.zeros(len(head), np.int64)
        smaller[by_symbol] = np.r_[0, np.cumsum(self.run_size[by_symbol])[:-1]]
        self.run_lf = smaller  # row of the suffix one symbol longer than that of the run's first row
        self.length = length
        self.run_of = np.repeat(np.arange(len(head), dtype=np.int32), self.run_size)  # directory: run of a row
        same = self._agree(rows, grams, length)
        self.interval_start = np.flatnonzero(np.r_[True, ~same])
        self.interval_size = np.diff(np.r_[self.interval_start, self.n])
        self.end_row = np.empty(self.n, np.int64)
        self.end_row[rows] = np.arange(self.n)
        self.end_row = self.end_row[self.ends]

    def _suffixes(self, symbols: np.ndarray, length: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Sorted suffixes: ranks of strings of one size give those of three times the size (twice, for a very large text);
        and the ranks of the largest size up to ``length``."""
        n = len(symbols)
        left = np.repeat(self.ends, self.sizes + 1) - np.arange(n)  # symbols before the mark
        size, grams = min(8, length), []
        padded = np.r_[symbols, np.zeros(8, np.int64)].astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for j in range(size):
            key = (key << np.uint64(8)) | padded[j:j + n]
        short = np.flatnonzero(left < size)  # nothing counts after the mark
        keep = (8 * (size - left[short])).astype(np.uint64)
        key[short] = (key[short] >> keep) << keep
        bits, times = (21, 3) if n < 1 << 21 else (32, 2)
        while True:
            order = np.argsort(key)
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
            if size <= length:
                grams = [(size, rank)]
            if size > left.max():
                break
            key = rank
            for k in range(1, times):
                further = np.zeros(n, np.int64)
                inside = np.flatnonzero(left >= k * size)
                further[inside] = rank[inside + k * size] + 1
                key = (key << bits) | further
            key = key.view(np.uint64)
            size *= times
        # Suffixes that end alike differ by their marks, which count in text order.
        return np.argsort((rank << 32) | np.arange(n)), [*grams, (0, left)]

    @staticmethod
    def _agree(rows: np.ndarray, grams: list[tuple[int, np.ndarray]], length: int) -> np.ndarray:
        """Whether each row agrees with the one before in ``length`` symbols: two strings that overlap cover them."""
        size, rank = grams[0]
        left = grams[1][1]
        a, b = rows[:-1], rows[1:]
        ok = (left[a] >= length) & (left[b] >= length)
        a, b = a[ok], b[ok]
        same = rank[a] == rank[b]
        at = size
        while at < length:
            step = min(at, length - size)
            same &= rank[a + step] == rank[b + step]
            at = step + size
        ok[np.flatnonzero(ok)[~same]] = False
        return ok

    def step(self, rows: np.ndarray) -> np.ndarray:
        """LF: the rows of the suffixes one symbol longer."""
        run = self.run_of[rows]
        return self.run_lf[run] + rows - self.run_start[run]

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, place): all places where a match of ``length`` symbols also starts earlier, texts in the given order."""
        first = np.full(len(self.interval_start), np.iinfo(np.int64).max)
        order = np.argsort(-self.sizes, kind="stable")
        rows = self.end_row[order]
        active = np.searchsorted(-self.sizes[order], -np.arange(1, self.sizes.max(initial=0) + 1), side="right")
        begin = (self.ends - self.sizes)[order]
        found_at, found_in = [], []
        for back in range(1, len(active) + 1):
            rows = self.step(rows[:active[back - 1]])
            if back < self.length:
                continue  # too little is left for a match of that length
            interval = np.searchsorted(self.interval_start, rows, side="right") - 1
            some = np.flatnonzero(self.interval_size[interval] > 1)
            if len(some):
                places = begin[some] + self.sizes[order[some]] - back
                np.minimum.at(first, interval[some], places)
                found_at.append(places)
                found_in.append(interval[some])
        if not found_at:
            none = np.zeros(0, np.int64)
            return none, none
        at, interval = np.concatenate(found_at), np.concatenate(found_in)
        at = np.sort(at[at > first[interval]])
        text = np.searchsorted(self.ends, at)
        return text, at - (self.ends - self.sizes)[text]


def _cut(length: int):
    """The bytes of the listed segments of each text; of a crowded anchor's segments the hashes of their strings, dealt by
    these (``k``), so that no task gathers the anchor."""
    names = [c.split()[0] for c in _CUT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, rk, text, parts in zip(batch["doc"], batch["rk"], batch["text"], batch["parts"]):
                data = text.encode("utf-8", "surrogatepass")
                for s in parts:
                    h, lo, n = s["h"], s["lo"], s["n"]
                    if not s["crowded"]:
                        rows.append((h, h, doc, rk, lo, data[lo:lo + n], None))
                        continue
                    for at in range(lo, lo + n - length + 1):
                        gram = xxhash.xxh3_128_digest(data[at:at + length])
                        rows.append((int.from_bytes(gram[:8], "little", signed=True), h, doc, rk, at, None, gram))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)
    return run


_CUT = "k long, h long, doc long, rk long, lo int, data binary, gram binary"
_MARKS = "doc long, rk long, start int, stop int, gram binary"


def _mark(length: int, block: int, largest: int):
    """Rows sorted by (k, h, place): marked spans; hashes of strings (``gram``) go through, and an anchor whose segments
    turn out larger than ``largest`` becomes hashes too."""
    def indexed(rows: list[tuple]) -> pd.DataFrame:
        text, at = RunLengthIndex([r[4] for r in rows], length).repeated()
        start = np.array([r[3] for r in rows], np.int64)[text] + at
        doc, rk = (np.array([r[i] for r in rows], np.int64)[text] for i in (1, 2))
        new = np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)][:len(start)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(start)] - 1
        return pd.DataFrame({"doc": doc[first], "rk": rk[first], "start": start[first], "stop": start[last] + length,
                             "gram": None}) if len(start) else pd.DataFrame({c.split()[0]: [] for c in _MARKS.split(", ")})

    def hashed(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(doc, rk, lo + i, lo + i + length, xxhash.xxh3_128_digest(data[i:i + length]))
                             for _, doc, rk, lo, data in rows for i in range(len(data) - length + 1)],
                            columns=[c.split()[0] for c in _MARKS.split(", ")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: list[tuple] = []  # whole anchors
        group: list[tuple] = []
        ready_bytes = group_bytes = 0
        large = False
        for batch in batches:
            hashes = batch["gram"].notna()
            if hashes.any():
                ready_made = batch[hashes]
                yield pd.DataFrame({"doc": ready_made["doc"], "rk": ready_made["rk"], "start": ready_made["lo"],
                                    "stop": ready_made["lo"] + length, "gram": ready_made["gram"]})
                batch = batch[~hashes]
            for row in batch[["h", "doc", "rk", "lo", "data"]].itertuples(index=False, name=None):
                if group and group[0][0] != row[0]:
                    if large:
                        yield hashed(group)
                    else:
                        ready += group
                        ready_bytes += group_bytes
                        if ready_bytes >= block:
                            yield indexed(ready)
                            ready, ready_bytes = [], 0
                    group, group_bytes, large = [], 0, False
                group.append(row)
                group_bytes += len(row[4])
                if group_bytes > largest:
                    large = True
                    yield hashed(group[:-1])
                    group, group_bytes = group[-1:], 0
        if large:
            yield hashed(group)
        else:
            ready += group
        if ready:
            yield indexed(ready)
    return run


_KEPT = ("doc long, rk long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
         "spans array<struct<start:int,stop:int>>")


def _remove(with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, rk, text, marks in zip(batch["doc"], batch["rk"], batch["text"], batch["marks"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                spans: list[list[int]] = []
                for m in sorted(((m["start"], m["stop"]) for m in marks) if marks is not None else ()):
                    if spans and m[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], m[1])
                    else:
                        spans.append(list(m))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                rows.append((doc, rk, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                             kept if with_text else None, [{"start": a, "stop": b} for a, b in spans]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _KEPT.split(", ")[:7]] + ["spans"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, largest: int = LARGEST,
                   crowded: int = CROWDED, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` (byte offsets)
    and, with ``with_text``, ``kept`` (the remaining bytes) and ``rk`` (``common.row_key``).

    Null and empty texts have no bytes.  Rows with one id but different texts are ordered by the hash of the text; repeated
    rows (equal id and text) count as one document and share its result; null ids come before all others.  Extra columns
    are ignored; an empty table gives no rows."""
    null_id = -(1 << 63)
    rows = texts_of(docs, id_col, text_col).withColumn("rk", row_key()).select(
        F.coalesce("doc_id", F.lit(null_id)).alias("doc"), "rk", "text")
    found = rows.filter(F.octet_length("text") >= length).mapInPandas(
        _anchors(length, gram, HELD), "h long, s long, doc long, rk long, lo int, n int, again boolean, k long")
    sifted = materialize(found.repartition("k").sortWithinPartitions("k", *_ORDER).mapInPandas(
        _sift, "h long, s long, doc long, rk long, lo int, n int, again boolean"), "anchors")
    whole = sifted.filter("again").select("doc", "rk", F.col("lo").alias("start"), (F.col("lo") + F.col("n")).alias("stop"))
    left = sifted.filter("NOT again")
    crowds = (left.groupBy("h").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > crowded)
              .select("h", F.lit(True).alias("crowded")))
    wanted = (left.join(broadcast_if_within(crowds, CROWDS_SENT), "h", "left").groupBy("doc", "rk")
              .agg(F.collect_list(F.struct("h", "lo", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("parts")))
    cut = rows.join(wanted, ["doc", "rk"]).mapInPandas(_cut(length), _CUT)
    marked = materialize(cut.dropDuplicates(["k", "h", "doc", "rk", "lo"]).repartition("k")
                         .sortWithinPartitions("k", "h", "doc", "rk", "lo").mapInPandas(_mark(length, block, largest), _MARKS), "marks")
    grams = marked.filter("gram IS NOT NULL")
    place = F.struct("doc", "rk", "start")
    later = (grams.join(grams.groupBy("gram").agg(F.min(place).alias("first")), "gram").filter(place > F.col("first"))
             .select("doc", "rk", "start", "stop"))
    marks = (whole.unionByName(marked.filter("gram IS NULL").select("doc", "rk", "start", "stop")).unionByName(later)
             .groupBy("doc", "rk").agg(F.collect_list(F.struct("start", "stop")).alias("marks")))
    out = rows.join(marks, ["doc", "rk"], "left").mapInPandas(_remove(with_text), _KEPT)
    doc_id = F.when(F.col("doc") != null_id, F.col("doc")).alias("doc_id")
    return out.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *(["kept", "rk"] if with_text else []))
