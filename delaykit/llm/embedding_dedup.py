"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length one and rotated onto their principal axes (products stay the same), so the leading
dimensions carry most of a product.  Distinct vectors are cut into tiles along the first axis; a tile that holds too many
is cut further by a hash.  Two tiles are compared unless their ranges on the first axis are too far apart for any pair to
reach the threshold.  Inside a pair of tiles the products of the leading dimensions are accumulated first; the rest of a
product is at most the product of the suffix norms, so a pair stops as soon as it can't reach the threshold.  What is left
is decided by the cosine of the given vectors in double precision.

A pair of tiles gives back counts of links per vector and a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.components import components
from delaykit.session import materialize

THRESHOLD, TILE, LEAD, SLACK, STEP = 0.9, 4096, 16, 1e-9, 65536


def _moments(dim: int):
    """Per task the sums of products of the coordinates, one row a coordinate."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_list()).astype(np.float64)
                x /= np.linalg.norm(x, axis=1)[:, None]
                total += x.T @ x
        yield pd.DataFrame({"i": np.arange(dim), "row": list(total)})
    return run


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """dim x dim rotation, the axis of the largest second moment first.  Only dim^2 sums reach the driver."""
    rows = (vectors.select("v").mapInPandas(_moments(dim), "i int, row array<double>")
            .select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect())
    m = np.zeros((dim, dim))
    for r in rows:
        m[r.i, r.j] = r.x
    return np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy()


def usable(embedding) -> F.Column:
    """Not null, no null or non-finite component, some component not zero."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(embedding, good) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _hook(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the ends of links: roots go under smaller ones, then paths are shortened, until nothing moves."""
    while True:
        ra, rb = low[a], low[b]
        big, small = np.maximum(ra, rb), np.minimum(ra, rb)
        apart = big != small
        if not apart.any():
            return
        np.minimum.at(low, big[apart], small[apart])
        while (low[low] != low).any():
            low[:] = low[low]


def _compare(axes: np.ndarray, threshold: float, lead: int):
    """Groups (i, j) of rows (side-tile, node, weight, v): links per node and a forest, as rows (node, links, a, b)."""
    def pair(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        raw = [np.stack(s["v"].to_list()).astype(np.float64) for s in (left, right)]
        unit = [x / np.linalg.norm(x, axis=1)[:, None] for x in raw]
        turned = [x @ axes for x in unit]
        rest = [np.linalg.norm(x[:, lead:], axis=1) for x in turned]
        further = [(upto, [np.linalg.norm(x[:, upto:], axis=1) for x in turned]) for upto in range(2 * lead, axes.shape[0], lead)]
        nodes = [s["node"].to_numpy() for s in (left, right)]
        weights = [s["weight"].to_numpy() for s in (left, right)]
        found = [np.zeros(len(n), np.int64) for n in nodes]
        ids = np.unique(np.concatenate(nodes))
        low = np.arange(len(ids))  # the smallest node each one is known to reach
        place = [np.searchsorted(ids, n) for n in nodes]

        for lo in range(0, len(left), 512):
            hi = min(lo + 512, len(left))
            first = lo if same else 0  # one tile: pairs (x, y) with y after x
            partial = turned[0][lo:hi, :lead] @ turned[1][first:, :lead].T
            partial += np.outer(rest[0][lo:hi], rest[1][first:])
            x, y = np.nonzero(partial >= threshold - SLACK)
            x, y = x + lo, y + first
            if same:
                x, y = x[y > x], y[y > x]
            for upto, tails in further:  # longer prefixes for the pairs that are left
                keep = [np.einsum("ij,ij->i", turned[0][x[k:k + STEP], :upto], turned[1][y[k:k + STEP], :upto])
                        + tails[0][x[k:k + STEP]] * tails[1][y[k:k + STEP]] >= threshold - SLACK
                        for k in range(0, len(x), STEP)]
                if keep:
                    x, y = x[np.concatenate(keep)], y[np.concatenate(keep)]
            for k in range(0, len(x), STEP):
                p, q = x[k:k + STEP], y[k:k + STEP]
                ok = np.einsum("ij,ij->i", unit[0][p], unit[1][q]) >= threshold
                p, q = p[ok], q[ok]
                np.add.at(found[0], p, weights[1][q])
                np.add.at(found[1], q, weights[0][p])
                _hook(low, place[0][p], place[1][q])
        counts = [pd.DataFrame({"node": n[f > 0], "links": f[f > 0]}) for n, f in zip(nodes, found)]
        away = np.flatnonzero(low != np.arange(len(ids)))
        return pd.concat([*counts, pd.DataFrame({"a": ids[away], "b": ids[low[away]]})], ignore_index=True).astype("Int64")

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        left, right = rows[rows["tile"] == i], rows[rows["tile"] == j]
        out = pair(left, right, i == j) if len(left) and len(right) else pd.DataFrame()
        return out.reindex(columns=["node", "links", "a", "b"]).astype("Int64")
    return run


def _tiles(ranged: DataFrame, parts: int, threshold: float, tile: int) -> tuple[DataFrame, DataFrame]:
    """The vectors with their ``tile``, and rows (i, j, tile): the pairs of tiles to compare, once for each side."""
    if parts < 2:
        one = F.lit("0/0")
        pair = ranged.sparkSession.createDataFrame([("0/0", "0/0", "0/0")], "i string, j string, tile string")
        return ranged.select(one.alias("tile"), "node", "weight", "v"), pair
    # Neighbouring ranges are taken together up to a tile, however finely the rows were dealt (rows: one a range).
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranged.groupBy(F.col("range").alias("piece")).agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    pieces = materialize(pieces.withColumn("range", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / tile)), "pieces")
    # A range with many equal places is cut by a hash.  Rows: one a tile.
    counts = materialize(pieces.groupBy("range").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        "range", F.ceil(F.col("n") / (2 * tile)).cast("int").alias("parts"), "lo", "hi"), "ranges")
    tiles = counts.select("range", "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    tiles = tiles.select(F.concat_ws("/", "range", "part").alias("tile"), "lo", "hi")
    # Tiles whose ranges are within reach of each other: |a - b|^2 = 2 - 2 cos for unit vectors.  Joined by cells of that width.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    cells = lambda t: F.explode(F.sequence(F.floor((F.col("lo")) / reach), F.floor(F.col("hi") / reach) + (1 if t else 0)))
    left = tiles.select(F.col("tile").alias("i"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"), cells(True).alias("cell"))
    right = tiles.select(F.col("tile").alias("j"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), cells(False).alias("cell"))
    near = left.join(right, "cell").filter((F.col("lo2") - F.col("hi1") <= reach) & (F.col("lo1") - F.col("hi2") <= reach))
    near = near.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()
    dealt = near.select("i", "j", F.col("i").alias("tile")).unionByName(
        near.filter("i < j").select("i", "j", F.col("j").alias("tile")))
    named = pieces.select("piece", "range").join(counts.select("range", "parts"), "range")
    own = ranged.withColumnRenamed("range", "piece").join(named, "piece")
    return own.select(F.concat_ws("/", "range", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("tile"), "node", "weight", "v"), dealt


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, lead: int = LEAD,
                 id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors with a cosine of at least ``threshold``),
    ``component_id`` (smallest id reachable by links, itself included), ``kept``.

    Vectors that are null, all zero or hold null or non-finite components link with nothing; so do rows with a null id
    (their component is null).  Vectors of different lengths have no cosine; those of one length are compared among
    themselves, each length by its own axes.  Repeated rows count as links of each other.  Extra columns are ignored; an
    empty table gives no rows."""
    rows = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), embeddings[vec_col].alias("v"))
    good = usable("v") & F.col("vec_id").isNotNull()
    # Equal vectors are one node, named by their smallest id; its weight is their number.
    nodes = materialize(rows.filter(good).groupBy("v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")),
                        "vectors")
    sizes = nodes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()  # one row a length
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = None
    for d, n in sizes:
        own = _compared(nodes.filter(F.size("v") == d), d, n, threshold, tile, lead)
        found = own if found is None else found.unionByName(own)
    links = found.filter("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(found.filter("a IS NOT NULL").select("a", "b"))
    classes = (nodes.join(links, "node", "left").join(comps, "node", "left")
               .select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                       F.coalesce("component", "node").alias("component_id")))
    linked = rows.filter(good).join(classes, "v").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _compared(nodes: DataFrame, dim: int, n: int, threshold: float, tile: int, lead: int) -> DataFrame:
    """(node, links, a, b) of the vectors of one length: links per node and forests of the links, pair of tiles by pair."""
    axes = principal_axes(nodes, dim)
    first = [float(x) for x in axes[:, 0]]
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    turned = F.aggregate(F.zip_with("v", F.array(*map(F.lit, first)), lambda x, a: x.cast("double") * a),
                         F.lit(0.0), lambda s, x: s + x) / size
    parts = max(1, -(-n // tile))
    placed = nodes.withColumn("p", turned)
    if parts > 1:  # the range a row was sorted into is written with it
        placed = placed.repartitionByRange(parts, "p").withColumn("range", F.spark_partition_id())
    own, dealt = _tiles(materialize(placed, "ordered"), parts, threshold, tile)
    return materialize(own.join(dealt, "tile").groupBy("i", "j").applyInPandas(
        _compare(axes, threshold, lead), "node long, links long, a long, b long"), "compared")
