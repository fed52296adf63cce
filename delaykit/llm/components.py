"""Connected components of a link table, as joins and minimum aggregates with the lineage cut once a round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.session import materialize

MAX_ROUNDS = 60
LOCAL_LINKS = 1_000_000  # links that one task contracts: 16 bytes each


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stars of the links of one partition: every node under the smallest it reaches there."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    links = pd.concat(parts, ignore_index=True)
    nodes, at = np.unique(np.concatenate([links["u"], links["v"]]), return_inverse=True)
    u, v = at[:len(links)], at[len(links):]
    low = np.arange(len(nodes))
    while True:  # hooks roots under smaller ones, then shortens the paths
        ru, rv = low[u], low[v]
        big, small = np.maximum(ru, rv), np.minimum(ru, rv)
        if not (big != small).any():
            break
        np.minimum.at(low, big, small)
        while (low[low] != low).any():
            low = low[low]
    away = np.flatnonzero(low != np.arange(len(nodes)))
    yield pd.DataFrame({"u": nodes[away], "v": nodes[low[away]]})


def _contracted(pairs: DataFrame) -> tuple[DataFrame, bool]:
    """``pairs``, written, with the links of every LOCAL_LINKS contracted; and whether one task saw them all."""
    tasks = max(1, -(-pairs.count() // LOCAL_LINKS))
    return materialize(pairs.coalesce(tasks).mapInPandas(_contract, "u long, v long"), "stars"), tasks == 1


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every node that has a link.

    Links are first contracted inside partitions of a bounded number of links.  Alternating star contraction joins the
    partitions: every round hangs the larger neighbours of each node, then its smaller ones, under its smallest
    neighbour, until only stars are left (a number of rounds that grows with the logarithm of the longest path).  A node
    with very many links is a key of a minimum aggregate (combined map-side) and of a join against one row per key, which
    AQE splits; no neighbour list is ever collected.

    Null ends and self links are ignored; repeated links count once; no links give no rows."""
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    pairs, settled = _contracted(materialize(pairs, "links"))
    for _ in range(MAX_ROUNDS):
        if settled or not _loose(pairs):
            break
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours go under the smallest one.
        large = (both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        # Small star: every node's smaller neighbours, and itself, go under the smallest.
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("p")).select("p.*").filter("u != v").distinct())
        pairs, settled = _contracted(materialize(small, "links"))
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _loose(pairs: DataFrame) -> bool:
    """Whether a right end is also a left end, or a left end has two right ends: not yet stars."""
    chained = pairs.select(F.col("v").alias("u")).distinct().join(pairs.select("u").distinct(), "u", "left_semi")
    forked = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
    return chained.unionByName(forked).limit(1).count() > 0
