"""A regression tree by histograms, grown level by level as DataFrame aggregates (M4, M5).

Rows are first counted once, map-side combined, into cells: the fold and the bin of every feature, with the number and sum of
the labels, if the bins allow no more than ``GRID`` cells (else each row is a cell of its own).  A level is one aggregate: cells,
with the node they are in, count into (tree, node, feature, bin), combined map-side; the best split of a node (largest fall of the squared error; ties: first feature, then
smallest cut) comes from running sums over the bins.  Labels are summed as exact decimals and cuts come from exact counts,
so a tree doesn't depend on partitions, task order or a seed.  The trees of all folds of a cross-validation grow together
in the same aggregates.  The driver holds splits, at most 2^depth a tree, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.session import materialize

BINS, CELLS, DEPTH = 32, 4096, 4
GRID = 100_000  # cells that rows are counted into at most
LABEL = "decimal(20,6)"  # labels count in millionths, exactly


@dataclass
class Tree:
    """``splits``: node -> (feature, cut): rows with feature <= cut go to node 2n, the others to 2n + 1 (the root is 1);
    ``values``: mean label of every node; ``sizes``: its rows."""
    splits: dict[int, tuple[str, float]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    sizes: dict[int, int] = field(default_factory=dict)

    def node(self, at: int = 1) -> Column:
        """The leaf of a row, as an expression."""
        if at not in self.splits:
            return F.lit(at)
        feature, cut = self.splits[at]
        return F.when(F.col(f"`{feature}`") <= F.lit(cut), self.node(2 * at)).otherwise(self.node(2 * at + 1))

    def node_of_bins(self, bins: dict[str, str], cuts: dict[str, list[float]], at: int = 1) -> Column:
        """The leaf by the columns of bins, named by feature: cuts are the trees' own, so a bin is on one side of a split."""
        if at not in self.splits:
            return F.lit(at)
        feature, cut = self.splits[at]
        left = F.col(bins[feature]) <= F.lit(cuts[feature].index(cut))
        return F.when(left, self.node_of_bins(bins, cuts, 2 * at)).otherwise(self.node_of_bins(bins, cuts, 2 * at + 1))

    def prediction(self, at: int = 1) -> Column:
        if at not in self.splits:
            return F.lit(self.values[at])
        feature, cut = self.splits[at]
        return F.when(F.col(f"`{feature}`") <= F.lit(cut), self.prediction(2 * at)).otherwise(self.prediction(2 * at + 1))

    def rows(self) -> list[tuple]:
        """(node, feature, cut, n, value), leaves without feature and cut."""
        return [(n, *self.splits.get(n, (None, None)), self.sizes[n], self.values[n]) for n in sorted(self.values)]


def equal_frequency_cuts(train: DataFrame, feature_cols: Sequence[str], bins: int = BINS, cells: int = CELLS) -> dict[str, list[float]]:
    """Per feature at most ``bins - 1`` cuts that part the rows about equally: edges of ``cells`` equally wide cells
    between the feature's least and largest value, chosen by the cells' exact counts (two scans; NULL and NaN don't
    count)."""
    value = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in feature_cols}
    ends = train.agg(*[f(value[c]).alias(f"{k}{i}") for i, c in enumerate(feature_cols) for k, f in (("a", F.min), ("b", F.max))]).first()
    spans = {c: (ends[f"a{i}"], ends[f"b{i}"]) for i, c in enumerate(feature_cols) if ends[f"a{i}"] is not None and ends[f"a{i}"] < ends[f"b{i}"]}
    if not spans:
        return {c: [] for c in feature_cols}
    cell = [F.struct(F.lit(c).alias("feature"), F.least(F.lit(cells - 1), F.floor((value[c] - F.lit(a)) / F.lit((b - a) / cells))).alias("cell"))
            for c, (a, b) in spans.items()]
    counts = (train.select(F.explode(F.array(*cell)).alias("x")).select("x.feature", "x.cell").filter("cell IS NOT NULL")
                   .groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n")))
    by_cell = Window.partitionBy("feature").orderBy("cell")  # at most ``cells`` rows a feature
    ranked = counts.withColumn("upto", F.sum("n").over(by_cell)).withColumn("all", F.sum("n").over(Window.partitionBy("feature")))
    share = F.floor(F.col("upto") * bins / F.col("all"))
    before = F.floor((F.col("upto") - F.col("n")) * bins / F.col("all"))
    edges = ranked.filter((share > before) & (F.col("upto") < F.col("all"))).select("feature", "cell").collect()  # below ``bins`` a feature
    out: dict[str, list[float]] = {c: [] for c in feature_cols}
    for r in edges:
        a, b = spans[r.feature]
        out[r.feature].append(a + (r.cell + 1) * ((b - a) / cells))
    return {c: sorted(v) for c, v in out.items()}


def _bin(feature: str, cuts: Sequence[float]) -> Column:
    """Number of cuts below the value: rows of bin b go left of cut number b and all later ones."""
    return reduce(lambda a, c: a + (F.col(f"`{feature}`") > F.lit(c)).cast("int"), cuts, F.lit(0))


def grow(train: DataFrame, feature_cols: Sequence[str], label_col: str = "delay_minutes", depth: int = DEPTH,
         cuts: dict[str, list[float]] | None = None, min_rows: int = 1, fold_col: str | None = None,
         folds: Sequence[int] = ()) -> dict[int, Tree]:
    """Trees by number: tree 0 of all rows or, with ``fold_col``, for each of ``folds`` the tree of the rows outside it.

    ``train`` must hold no NULL or NaN feature or label; write it first (``session.materialize``): it is scanned once, or once a
    level where the cells are too many."""
    cuts = equal_frequency_cuts(train, feature_cols) if cuts is None else cuts
    used = [c for c in feature_cols if cuts.get(c)]
    trees = {t: Tree() for t in (folds if fold_col else [0])}
    bins = {c: f"__b{i}" for i, c in enumerate(used)}
    cells = train.select(*[_bin(c, cuts[c]).alias(bins[c]) for c in used], F.col(f"`{label_col}`").cast(LABEL).alias("__s"),
                         (F.lit(0) if fold_col is None else F.col(fold_col)).alias("__fold"), F.lit(1).cast("long").alias("__n"))
    if math.prod(len(cuts[c]) + 1 for c in used) * max(len(trees), 1) <= GRID:
        cells = materialize(cells.groupBy("__fold", *bins.values()).agg(F.sum("__s").alias("__s"), F.sum("__n").alias("__n")), "cells")
    for level in range(depth + 1):
        base = 1 << level
        here = [F.when(F.lit(True) if fold_col is None else F.col("__fold") != t,
                       F.struct(F.lit(t).alias("tree"), tree.node_of_bins(bins, cuts).alias("node"))) for t, tree in trees.items()]
        placed = cells.select(*bins.values(), "__s", "__n",
                              F.explode(F.array_compact(F.array(*here))).alias("__at")).filter(F.col("__at.node") >= base)
        binned = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"__b{i}").alias("bin")) for i in range(len(used))],
                         F.struct(F.lit(-1).alias("feature"), F.lit(0).alias("bin")))  # feature -1 is the node itself
        sums = (placed.select("__at.tree", "__at.node", "__s", "__n", F.inline(binned)).groupBy("tree", "node", "feature", "bin")
                      .agg(F.sum("__n").alias("n"), F.sum("__s").alias("s")))
        best = _best_splits(sums, min_rows).collect()  # one row a node of this level
        grew = False
        for r in best:
            tree = trees[r.tree]
            tree.sizes[r.node], tree.values[r.node] = r.n, float(r.s) / r.n
            if level < depth and r.split is not None:
                name = used[r.split.feature]
                tree.splits[r.node] = (name, cuts[name][r.split.bin])
                grew = True
        if not grew:
            break
    return trees


def _best_splits(sums: DataFrame, min_rows: int) -> DataFrame:
    """Per (tree, node): its rows ``n``, label sum ``s`` and the best ``split`` (feature, bin), NULL if none helps."""
    node = ["tree", "node"]
    whole = sums.filter("feature = -1").select(*node, F.col("n").alias("all"), F.col("s").alias("total"))
    upto = Window.partitionBy(*node, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # bins, not rows
    left = sums.filter("feature >= 0").withColumn("nl", F.sum("n").over(upto)).withColumn("sl", F.sum("s").over(upto))
    tried = left.join(whole, node).filter((F.col("nl") >= min_rows) & (F.col("all") - F.col("nl") >= F.greatest(F.lit(min_rows), F.lit(1))))
    sl, sr, st = (c.cast("double") for c in (F.col("sl"), F.col("total") - F.col("sl"), F.col("total")))
    gain = sl * sl / F.col("nl") + sr * sr / (F.col("all") - F.col("nl")) - st * st / F.col("all")
    best = (tried.select(*node, "feature", "bin", gain.alias("gain")).filter(F.col("gain") > 1e-9)
                 .groupBy(*node).agg(F.min_by(F.struct("feature", "bin"), F.struct(-F.col("gain"), "feature", "bin")).alias("split")))
    return whole.join(best, node, "left").select(*node, F.col("all").alias("n"), F.col("total").alias("s"), "split")


def fold_scores(train: DataFrame, feature_cols: Sequence[str], label_col: str = "delay_minutes", fold_col: str = "fold",
                k: int = 3, depth: int = DEPTH, cuts: dict[str, list[float]] | None = None, min_rows: int = 1) -> dict[int, float]:
    """Negative mean squared error on every fold of the tree grown on the others: ``depth + 1`` scans for all trees and one
    for all scores."""
    trees = grow(train, feature_cols, label_col, depth, cuts, min_rows, fold_col, range(k))
    guess = F.coalesce(*[F.when(F.col(fold_col) == t, tree.prediction()) for t, tree in trees.items() if tree.values])
    error = F.col(f"`{label_col}`").cast("double") - guess
    scored = train.groupBy(fold_col).agg(F.avg(error * error).alias("mse")).collect()
    return {r[0]: -r["mse"] for r in sorted(scored)}
