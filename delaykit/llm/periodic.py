"""Runs of repeated words by online dyadic square catching, and texts with such runs collapsed.

Words are appended to a ``SquareCatcher``.  For every power of two B, each completed block of B words that starts at a
multiple of B gets a catcher, which waits for the block's next occurrence between 2B and 4B words further on: an appended
word completes one suffix of B words, and just two catchers of a size look at it.  A square of period q >= 2 holds a whole
block of the largest B <= q / 2 in its first half, so its catcher meets the copy at distance q; neighbouring words settle
q = 1.  A catch is carried left and right while words q apart are equal.  Squares of one period that touch are one run;
the run at the end of the text stays open and grows with the words appended later.

The work a word is two comparisons for each of log n block sizes, in numpy over the words appended together; blocks are
compared by 64-bit hashes, and every reported run is checked word by word (a false one would have the text searched period by
period).

Results: null and empty texts, and texts without a run, have none; every row is judged by itself, so repeated rows and null
ids are rows like any other; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import map_rows, texts_of

MIN_LENGTH, MIN_PERIODS = 6, 4
_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
Run = tuple[int, int, int]  # start, length, period


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(30))) * _ODD[1]
    return v ^ (v >> np.uint64(29))


class SquareCatcher:
    """Maximal squares (length at least two periods) of the words appended so far, as {(start, period): end}."""

    def __init__(self):
        self.words = np.zeros(0, np.int64)
        self.hashes: list[np.ndarray] = []  # of the 2^level words from each position on
        self.squares: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray) -> None:
        """``words``: numbers, equal for equal words."""
        old = len(self.words)
        if not len(words):
            return
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        n = len(self.words)
        self._extend_hashes(n)
        self._extend_open(old, n)
        self._neighbours(old, n)
        level = 0
        while 3 << level <= n:
            self._catch(level, max(old - (1 << level) + 1, 2 << level), n - (1 << level) + 1)
            level += 1

    def _extend_hashes(self, n: int) -> None:
        level = 0
        while 1 << level <= n:
            if level == len(self.hashes):
                self.hashes.append(np.zeros(0, np.uint64))
            done, half = len(self.hashes[level]), (1 << level) >> 1
            if level == 0:
                new = _mixed((self.words[done:].astype(np.uint64) + np.uint64(1)) * _ODD[0])
            else:
                below, end = self.hashes[level - 1], n - (1 << level) + 1
                new = _mixed(below[done:end] * _ODD[2] + below[done + half:end + half] * _ODD[0])
            self.hashes[level] = np.concatenate([self.hashes[level], new]) if done else new
            level += 1

    def _ahead(self, s: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many words from ``s`` on equal those from ``x`` (> s) on."""
        length = np.zeros(len(s), np.int64)
        for level in range(len(self.hashes) - 1, -1, -1):
            h = self.hashes[level]
            while True:  # more than once on the highest level only
                at = x + length
                can = np.flatnonzero(at < len(h))
                can = can[h[at[can]] == h[(s + length)[can]]] if len(can) else can
                length[can] += 1 << level
                if level < len(self.hashes) - 1 or not len(can):
                    break
        return length

    def _behind(self, s: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many words before ``s`` equal those before ``x`` (> s)."""
        length = np.zeros(len(s), np.int64)
        for level in range(len(self.hashes) - 1, -1, -1):
            h, size = self.hashes[level], 1 << level
            while True:
                at = s - length - size
                can = np.flatnonzero(at >= 0)
                can = can[h[at[can]] == h[(x - length - size)[can]]] if len(can) else can
                length[can] += size
                if level < len(self.hashes) - 1 or not len(can):
                    break
        return length

    def _extend_open(self, old: int, n: int) -> None:
        keys = [k for k, end in self.squares.items() if end == old]
        if keys:
            period = np.array([q for _, q in keys])
            more = self._ahead(old - period, np.full(len(keys), old))
            self.squares.update(zip(keys, (old + more).tolist()))

    def _neighbours(self, old: int, n: int) -> None:
        """Period 1: the stretches of one word that the new words belong to."""
        first = max(old - 1, 0)
        w = self.words[first:n]
        cuts = np.flatnonzero(np.diff(w)) + 1
        starts = np.concatenate([[0], cuts]) + first
        ends = np.concatenate([cuts, [len(w)]]) + first
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            if s > first or s == 0 or self.words[s - 1] != self.words[s]:  # else an open run, extended already
                self.squares.setdefault((s, 1), e)

    def _catch(self, level: int, first: int, last: int) -> None:
        """The catchers of one block size look at the suffixes that start in [first, last)."""
        if first >= last:
            return
        h, size = self.hashes[level], 1 << level
        x = np.arange(first, last)
        block = x >> level
        at, later = [], []
        for back in (2, 3):
            s = (block - back) << level
            hit = np.flatnonzero((s >= 0) & (h[np.maximum(s, 0)] == h[x]))
            at.append(s[hit])
            later.append(x[hit])
        s, x = np.concatenate(at), np.concatenate(later)
        if not len(s):
            return
        q = x - s
        order = np.lexsort((s, q))
        s, x, q = s[order], x[order], q[order]
        chained = np.concatenate([[False], (q[1:] == q[:-1]) & (s[1:] - s[:-1] == size)])
        s, x, q = s[~chained], x[~chained], q[~chained]  # the next block of the same stretch says the same
        s, x, q = self._unknown(s, x, q, size)
        if not len(s):
            return
        start = s - self._behind(s, x)
        end = x + self._ahead(s, x)
        for a, e, p in zip(start.tolist(), end.tolist(), q.tolist()):
            if e - a >= 2 * p:
                self.squares[(a, p)] = e

    def _unknown(self, s, x, q, size):
        """Without the catches inside one of the longest runs, if its period divides theirs: they are squares of that run
        and would only say it again."""
        keep = np.ones(len(s), bool)
        longest = heapq.nlargest(64, ((e - a, a, p) for (a, p), e in self.squares.items() if e - a >= 4 * p))
        for length, a, p in longest:
            e = a + length
            keep &= (s < a) | (x + size > e) | (q % p != 0)
        return s[keep], x[keep], q[keep]

    def runs(self, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
        """Runs by start and period: smallest periods only, each compared word by word."""
        least: dict[tuple[int, int], int] = {}
        for (a, p), e in self.squares.items():
            if e - a >= max(min_length, min_periods * p):
                least[a, e] = min(p, least.get((a, e), p))
        w, found = self.words, []
        for (a, e), p in least.items():
            found.append((a, e - a, p))
            if not (np.array_equal(w[a:e - p], w[a + p:e]) and (a == 0 or w[a - 1] != w[a - 1 + p])
                    and (e == len(w) or w[e] != w[e - p])):
                return self._plain_runs(min_length, min_periods)  # different blocks had one hash
        return sorted(found, key=lambda r: (r[0], r[2]))

    def _plain_runs(self, min_length: int, min_periods: int) -> list[Run]:
        """All periods one by one, without hashes."""
        best: dict[tuple[int, int], int] = {}
        for p in range(1, len(self.words) // min_periods + 1):
            same = np.concatenate([[0], (self.words[p:] == self.words[:-p]).astype(np.int8), [0]])
            edge = np.flatnonzero(np.diff(same))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b + p - a >= max(min_length, min_periods * p):
                    best.setdefault((a, b + p - a), p)
        return sorted(((a, n, p) for (a, n), p in best.items()), key=lambda r: (r[0], r[2]))


def split_words(text: str | None) -> list[bytes]:
    """Words between white space (space, tab to carriage return), as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def runs_of(words: list, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
    """Runs of a list of words.  A run needs ``min_length`` words, so shorter lists have none."""
    if len(words) < max(min_length, min_periods):
        return []
    numbers: dict = {}
    catcher = SquareCatcher()
    catcher.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))
    return catcher.runs(min_length, min_periods) if len(numbers) < len(words) else []


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those of a run behind its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_periods: int = MIN_PERIODS, rewrite: Callable[[int | None, list], list] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` (array of start, length, period; by start, then period)
    and ``collapsed`` (the kept words joined by one space).

    ``rewrite``: makes the words that are searched from an id and its words."""
    def one(doc_id, text):
        words = split_words(text)
        if rewrite is not None:
            words = rewrite(doc_id, words)
        runs = runs_of(words, min_length, min_periods)
        kept = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
        return doc_id, len(words), [{"start": a, "length": n, "period": p} for a, n, p in runs], kept

    return map_rows(texts_of(docs, id_col, text_col), one,
                    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeat_tail(doc_id: int | None, words: list) -> list:
    """Words of every tenth document (by crc32 of the id) repeat one stretch from some place on to the end."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + p]
    return words[:a] + (stretch * ((n - a) // p + 1))[:n - a]


def run_digest(docs: DataFrame) -> DataFrame:
    """The longest run of a document (ties: smallest start, then period) and digests of all runs and of the kept words."""
    found = periodic_runs(docs, rewrite=repeat_tail)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    longest = found.withColumn("best", F.when(F.size("runs") > 0, best))
    length = -F.col("best.less")
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
