"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints: 64 bits, the majority vote of the hashes of a text's word shingles.  For radius ``r`` every bit
position gets a non-zero label of ``r + 1`` bits; the table of each non-zero vector ``v`` compares only the positions
whose label has an odd inner product with ``v``.  The labels of ``r`` differing positions span at most ``r``
dimensions, so some ``v`` is orthogonal to all of them: every pair within the radius collides in at least one of the
``2^(r+1) - 1`` tables, whatever the data.  Candidates are checked by their full distance.

Distinct fingerprints are linked, not documents: copies cost one row.  A bucket of many distinct fingerprints is cut
into blocks and every pair of blocks is a group of its own, so no group is larger than two blocks, and a group gives
back a spanning forest of its links rather than its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import row_key, texts_of
from delaykit.llm.components import components
from delaykit.session import materialize

SHINGLE, RADIUS, BLOCK, SEED = 3, 3, 4096, 42
_LANES = np.uint64(0x0101010101010101)


def bit_majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per segment of ``hashes`` (``starts``, ``counts`` > 0) the bits set in over half of it."""
    cuts = [np.arange(s, s + n, 255) for s, n in zip(starts.tolist(), counts.tolist())]  # byte lanes hold 255
    owner = np.repeat(np.arange(len(starts)), [len(c) for c in cuts])
    at = np.concatenate(cuts)
    out = np.zeros(len(starts), np.uint64)
    first = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
    for j in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, at)
        for byte in range(8):
            ones = np.add.reduceat(((lanes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64), first)
            out |= (2 * ones > counts).astype(np.uint64) << np.uint64(8 * byte + j)
    return out


def simhashes(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprints; a text without words has fingerprint zero."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        n = max(1, len(words) - shingle + 1)
        line = b" ".join(words)
        if n == 1:
            hashes.append(digest(line, SEED))
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            lo = [0, *ends[: n - 1].tolist()]
            hi = (ends[shingle - 1:] - 1).tolist()
            hashes.extend([digest(line[i:j], SEED) for i, j in zip(lo, hi)])
        counts[k] = n
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        starts = np.r_[0, np.cumsum(counts[some])[:-1]]
        out[some] = bit_majority(np.fromiter(hashes, np.uint64, len(hashes)), starts, counts[some])
    return out


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = texts.tolist()
            parts = [simhashes(values[i:i + 256], shingle) for i in range(0, len(values), 256)]
            yield pd.Series((np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64))
    return fingerprint


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The signed 64-bit masks of the ``2^(radius+1) - 1`` tables."""
    size = 2 ** (radius + 1) - 1
    labels = [i % size + 1 for i in range(bits)]
    masks = [sum(1 << i for i, x in enumerate(labels) if bin(x & v).count("1") % 2) for v in range(1, size + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(fp: np.ndarray, rows: np.ndarray, other: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two blocks of distinct fingerprints, given as places in ``fp`` (one block:
    ``other`` is ``rows``)."""
    parent = np.arange(len(fp))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    bits = fp.view(np.uint64)  # bitwise_count takes the absolute value of signed numbers
    for i in range(0, len(rows), 256):
        near = np.bitwise_count(bits[rows[i:i + 256], None] ^ bits[other][None, :]) <= radius
        for x, y in zip(*np.nonzero(near)):
            a, b = root(int(rows[i + x])), root(int(other[y]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(rows[i + x]), int(other[y])))
    return out


def _link_groups(radius: int):
    """Rows sorted by (t, key, i, j) with ``side`` 0/1: streams the groups, each at most two blocks large."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(part: pd.DataFrame) -> pd.DataFrame:
            out_a, out_b = [], []
            cols = [part[c].to_numpy() for c in ("t", "key", "i", "j")]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            fp, node, block = (part[c].to_numpy() for c in ("fp", "node", "block"))
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
                if hi - lo < 2:
                    continue
                own, i, j = block[lo:hi], cols[2][lo], cols[3][lo]
                for a, b in _forest(fp[lo:hi], np.flatnonzero(own == i), np.flatnonzero(own == j), radius):
                    out_a.append(node[lo + a])
                    out_b.append(node[lo + b])
            return pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})

        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = held.iloc[-1]
            tail = ((held["t"] == last["t"]) & (held["key"] == last["key"]) & (held["i"] == last["i"])
                    & (held["j"] == last["j"])).to_numpy()
            if not tail.all():
                yield solve(held[~tail])
                held = held[tail].reset_index(drop=True)
        if held is not None and len(held):
            yield solve(held)
    return run


def near_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the ``node`` of distinct values of ``fp`` that connect just what all pairs within ``radius``
    connect."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for t, m in enumerate(covering_masks(radius))])
    keyed = prints.select("fp", "node", F.explode(tables).alias("k")).select("fp", "node", "k.t", "k.key")
    full = (keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select("t", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    placed = keyed.join(full, ["t", "key"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    pairs = placed.select("t", "key", "fp", "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select(
        "t", "key", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "fp", "node", "block")
    return (pairs.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
            .mapInPandas(_link_groups(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable
    by links of at most ``radius`` differing bits, itself included).

    Null and empty texts have no words: fingerprint zero, linked like any other.  A null id links nothing and takes
    the component of its fingerprint (null if no document with an id is there).  Repeated rows give repeated results;
    extra columns are ignored; an empty table gives no rows."""
    prints = materialize(texts_of(docs, id_col, text_col).select("doc_id", fingerprint_udf(shingle)("text").alias("fp")),
                         "simhash")
    # One node per distinct fingerprint, named by its smallest document.
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    comps = components(near_links(nodes.filter("node IS NOT NULL"), radius))
    classes = nodes.join(comps, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per group of near duplicates: ``doc_id`` and ``rk`` (``common.row_key`` of the text) of the row that stands
    for it, and ``copies``, how many equal rows there are of it.

    Rows are told apart by id and text, so different texts of one id are judged apart.  The representative has the smallest
    id, of equal ids the smallest text key; rows without an id come last.  Only ids, keys and fingerprints are grouped and
    joined, no texts."""
    rows = texts_of(docs, id_col, text_col).withColumn("rk", row_key())
    prints = materialize(rows.select("doc_id", "rk", fingerprint_udf(shingle)("text").alias("fp")), "simhash")
    nodes = materialize(prints.select("fp", F.col("fp").alias("node")).distinct(), "nodes")
    comps = components(near_links(nodes, radius)).select(F.col("node").alias("fp"), "component")
    counted = prints.groupBy("fp", "doc_id", "rk").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rk")
    best = (counted.join(comps, "fp", "left").groupBy(F.coalesce("component", "fp").alias("group"))
            .agg(F.min_by(F.struct("doc_id", "rk", "copies"), order).alias("best")))
    return best.select("best.*")
