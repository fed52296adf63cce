"""Cross-validation of trees and forests of Spark's kinds in two scans of the rows, whatever folds, trees and levels (M3-M5).

Trees split at bins of the features (at most ``BINS``, as ``pyspark.ml`` does), and a split needs only the number and sum of
the labels left and right of it.  So rows are counted once into cells, a fold and the bin of every feature, with the number
and sum of the labels of all rows and of every bootstrap sample; each row draws how often each sample holds it.  All trees of
all folds then grow together, one aggregate of the cells a level, and are scored on the cells.  There are no more cells than
rows or combinations of bins; ``fits`` says when those are few enough, else callers fit row by row.

As in ``pyspark.ml``: the split with the largest fall of the squared error (ties: first feature, smallest cut), ``maxDepth``,
``minInstancesPerNode``, every feature at each split, Poisson(1) draws for the bootstrap, a forest's prediction is the mean of
its trees.  Cuts come from 10,000 evenly spaced quantiles of all rows in place of a sample of 10,000 rows.  Draws depend on the
seed and on the rows' partitions.  The driver holds splits, at most 2^depth a tree, never rows or cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.session import discard, materialize, workers_find_package

BINS, QUANTILES = 32, 10_000
GRID = 1 << 22  # combinations of bins at most
DEPTH = 12  # deeper trees are fitted row by row
CHUNK, FLUSH = 1 << 17, 1 << 18  # rows counted together, cells that a task holds
PER_BUCKET = 1 << 18  # rows for every bucket of cells
TREE, FOREST = "DecisionTreeRegressor", "RandomForestRegressor"
OPTIONS = {"maxDepth", "minInstancesPerNode", "seed", "numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate"}

_CELLS = "bucket long, code long, n binary, s binary, ss double"


def fits(name: str, params: dict, feature_cols: Sequence[str]) -> bool:
    """Whether a model with ``params`` can be scored here."""
    if name not in (TREE, FOREST) or set(params) - OPTIONS or params.get("maxDepth", 5) > DEPTH:
        return False
    whole = name == TREE or (params.get("featureSubsetStrategy") == "all" and params.get("subsamplingRate", 1.0) == 1.0)
    return whole and BINS ** len(feature_cols) <= GRID


def cuts_of(values: Sequence[float], bins: int = BINS) -> list[float]:
    """At most ``bins - 1`` cuts halfway between values that stand for equally many rows each."""
    distinct, counts = np.unique(np.asarray(values, float), return_counts=True)
    with np.errstate(invalid="ignore"):
        middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < bins:
        return [float(v) for v in middle if v == v]
    stride = target = counts.sum() / bins
    out, upto = [], np.cumsum(counts)
    for i in range(len(middle)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            out.append(float(middle[i]))
            target += stride
    return [v for v in out if v == v]


def _digits(codes: np.ndarray, sizes: Sequence[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Fold and bins of the features."""
    bins = []
    for size in reversed(sizes):
        codes, digit = np.divmod(codes, size)
        bins.append(digit)
    return codes, bins[::-1]


def _merge(codes: np.ndarray, *sums: np.ndarray) -> list[np.ndarray]:
    """Equal codes added up, sorted by code."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return [codes[first], *[np.add.reduceat(s[order], first, axis=0) for s in sums]]


def _count(cuts: list[list[float]], samples: list[bool], middle: float, folds: int, seed: int, buckets: int):
    """Rows to cells; ``samples`` says for each sample of the rows whether it is drawn or all rows."""
    def cells(rows: pd.DataFrame, rng: np.random.Generator) -> list[np.ndarray]:
        fold = rows["fold"].to_numpy()
        code = np.where((fold >= 0) & (fold < folds), fold, folds).astype(np.int64)
        for i, c in enumerate(cuts):
            code = code * (len(c) + 1) + np.searchsorted(c, rows[f"f{i}"].to_numpy(), side="left")
        y = rows["y"].to_numpy() - middle
        codes, at = np.unique(code, return_inverse=True)
        size = len(codes)
        n, s = np.empty((size, 1 + len(samples))), np.empty((size, 1 + len(samples)))
        n[:, 0], s[:, 0] = np.bincount(at, minlength=size), np.bincount(at, y, size)
        for t, drawn in enumerate(samples, 1):
            if drawn:
                times = rng.poisson(1.0, len(y)).astype(float)
                n[:, t], s[:, t] = np.bincount(at, times, size), np.bincount(at, times * y, size)
            else:
                n[:, t], s[:, t] = n[:, 0], s[:, 0]
        return [codes, n, s, np.bincount(at, y * y, size)]

    def frame(codes, n, s, ss) -> pd.DataFrame:
        return pd.DataFrame({"bucket": codes * 2654435761 % (1 << 32) % buckets, "code": codes, "n": [r.tobytes() for r in n],
                             "s": [r.tobytes() for r in s], "ss": ss})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        waiting, size, held = [], 0, None
        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size >= CHUNK:
                new = cells(pd.concat(waiting), rng)
                held = new if held is None else _merge(*[np.concatenate(p) for p in zip(held, new)])
                waiting, size = [], 0
                if len(held[0]) >= FLUSH:
                    yield frame(*held)
                    held = None
        if size:
            new = cells(pd.concat(waiting), rng)
            held = new if held is None else _merge(*[np.concatenate(p) for p in zip(held, new)])
        if held is not None:
            yield frame(*held)
    return run


def _sums(rows: pd.DataFrame) -> list[np.ndarray]:
    read = lambda c: np.frombuffer(b"".join(rows[c]), float).reshape(len(rows), -1)
    return [rows["code"].to_numpy(), read("n"), read("s"), rows["ss"].to_numpy()]


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    codes, n, s, ss = _merge(*_sums(rows))
    return pd.DataFrame({"bucket": rows["bucket"].iloc[0], "code": codes, "n": [r.tobytes() for r in n],
                         "s": [r.tobytes() for r in s], "ss": ss})


class Trees:
    """All trees by number: feature (-1: leaf) and bin of the split of each node, and its mean label; rows of bin <= split go to
    node 2n, the others to 2n + 1 (the root is 1)."""

    def __init__(self, number: int, depth: int):
        self.feature = np.full((number, 2 << depth), -1, np.int16)
        self.bin = np.zeros((number, 2 << depth), np.int16)
        self.value = np.zeros((number, 2 << depth))

    def nodes(self, tree: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each column of ``bins`` is in after so many levels."""
        at, every = np.ones(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(levels):
            feature = self.feature[tree][at]
            down = 2 * at + (bins[feature, every] > self.bin[tree][at])
            at = np.where(feature >= 0, down, at)
        return at


def _level(trees, plan: list[tuple[int, int, int]], sizes: list[int], level: int):
    """Histograms of the nodes of a level; ``plan``: for each tree its fold, sample and depth."""
    width, base = max(sizes), 1 << level

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown = trees.value
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        codes, n, s, _ = _sums(pd.concat(batches))
        fold, bins = _digits(codes, sizes)
        bins = np.stack(bins)
        for tree, (held, sample, depth) in enumerate(plan):
            if level >= depth:
                continue
            use = np.flatnonzero((fold != held) & (n[:, sample] > 0))
            at = grown.nodes(tree, bins[:, use], level)
            use, at = use[at >= base], at[at >= base]
            if not len(use):
                continue
            nodes, place = np.unique(at, return_inverse=True)
            hist = np.zeros((2, len(nodes), len(sizes), width))
            for i in range(len(sizes)):
                slot = place * width + bins[i, use]
                for k, sums in enumerate((n, s)):
                    hist[k, :, i] = np.bincount(slot, sums[use, sample], len(nodes) * width).reshape(-1, width)
            yield pd.DataFrame({"tree": tree, "node": nodes, "n": [h.tobytes() for h in hist[0]], "s": [h.tobytes() for h in hist[1]]})
    return run


def _best(features: int, least: dict[int, int]):
    """The best split of each node of a tree, with the numbers and means of both sides; feature -1 if none helps."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        read = lambda c: np.frombuffer(b"".join(rows[c]), float).reshape(len(rows), -1)
        nodes, n, s = _merge(rows["node"].to_numpy(), read("n"), read("s"))
        n, s = n.reshape(len(nodes), features, -1), s.reshape(len(nodes), features, -1)
        nl, sl = np.cumsum(n, axis=2), np.cumsum(s, axis=2)
        all_n, all_s = nl[:, :1, -1:], sl[:, :1, -1:]
        nr, sr = all_n - nl, all_s - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = sl * sl / nl + sr * sr / nr
            gain = parts - all_s * all_s / all_n
            worth = np.where((nl >= least[tree]) & (nr >= max(least[tree], 1)) & (nl > 0) & (gain > 1e-10 * parts), gain, -1.0)
        flat = worth.reshape(len(nodes), -1)
        best = flat.argmax(1)
        found = flat[np.arange(len(nodes)), best] > 0
        pick = lambda a: a.reshape(len(nodes), -1)[np.arange(len(nodes)), best]
        with np.errstate(divide="ignore", invalid="ignore"):
            left, right = pick(sl) / pick(nl), pick(sr) / pick(nr)
        return pd.DataFrame({"tree": tree, "node": nodes, "feature": np.where(found, best // n.shape[2], -1), "bin": best % n.shape[2],
                             "value": (all_s / all_n).ravel(), "left": np.where(found, left, 0.0), "right": np.where(found, right, 0.0)})
    return run


def _errors(trees, plan, models: list[list[int]], sizes: list[int]):
    """Sums of squared errors of each model on each fold; ``models``: the trees of a model, of all folds."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown = trees.value
        for batch in batches:
            codes, n, s, ss = _sums(batch)
            fold, bins = _digits(codes, sizes)
            bins = np.stack(bins)
            for held in sorted({f for f, _, _ in plan}):
                use = np.flatnonzero(fold == held)
                for m, members in enumerate(models):
                    mine = [t for t in members if plan[t][0] == held]
                    guess = sum(grown.value[t][grown.nodes(t, bins[:, use], plan[t][2])] for t in mine) / len(mine)
                    error = ss[use] - 2 * guess * s[use, 0] + guess * guess * n[use, 0]
                    yield pd.DataFrame({"model": [m], "fold": [held], "n": [n[use, 0].sum()], "error": [error.sum()]})
    return run


def fold_scores(train: DataFrame, feature_cols: Sequence[str], specs: dict[str, dict], label_col: str = "delay_minutes",
                fold_col: str = "fold", k: int = 3) -> dict[str, list[float]]:
    """For every model in ``specs`` (name -> parameters) the negative mean squared error on each fold of the model fitted on the
    others.  ``train`` is scanned twice, so write or cache it first.  A missing feature or label is an error."""
    workers_find_package(train.sparkSession)
    number = lambda c: F.col(f"`{c}`").cast("double")
    check = lambda c, what: F.when(c.isNull() | F.isnan(c), F.raise_error(F.lit(f"a {what} is missing")).cast("double")).otherwise(c)
    names = [f"f{i}" for i in range(len(feature_cols))]
    rows = train.filter(F.col(fold_col).isNotNull()).select(
        *[check(number(c), "feature; choose missing='skip' or 'impute'").alias(f) for f, c in zip(names, feature_cols)],
        check(number(label_col), "label").alias("y"), F.col(fold_col).cast("int").alias("fold"))
    steps = F.split(F.lit(" ".join(str((i + 0.5) / QUANTILES) for i in range(QUANTILES))), " ").cast("array<double>")  # one literal
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.avg("y").alias("middle"),
                    *[F.percentile_approx(f, steps, 2 * QUANTILES).alias(f) for f in names]).first()
    if not seen["rows"]:
        raise ValueError("no training rows")
    cuts = [cuts_of(seen[f]) for f in names]
    sizes = [len(c) + 1 for c in cuts]

    samples, plan, models, least = [], [], [], {}
    for name, params in specs.items():
        mine = [0]
        if name == FOREST:
            count = params.get("numTrees", 20)
            mine = list(range(len(samples) + 1, len(samples) + 1 + count))
            samples += [params.get("bootstrap", True)] * count
        models.append([])
        for held in range(k):
            for sample in mine:
                models[-1].append(len(plan))
                least[len(plan)] = params.get("minInstancesPerNode", 1)
                plan.append((held, sample, params.get("maxDepth", 5)))
    seed = next((p["seed"] for p in specs.values() if "seed" in p and "numTrees" in p), 0) % (1 << 32)

    buckets = 16 + seen["rows"] // PER_BUCKET
    counted = rows.mapInPandas(_count(cuts, samples, seen["middle"], k, seed, buckets), _CELLS)
    cells = materialize(counted.groupBy("bucket").applyInPandas(_add, _CELLS), "cells")
    context = train.sparkSession.sparkContext
    trees = Trees(len(plan), max(depth for _, _, depth in plan))
    for level in range(max(depth for _, _, depth in plan)):
        shared = context.broadcast(trees)  # bounded: nodes of the trees
        found = (cells.mapInPandas(_level(shared, plan, sizes, level), "tree int, node long, n binary, s binary").groupBy("tree")
                 .applyInPandas(_best(len(sizes), least), "tree int, node long, feature int, bin int, value double, left double, right double")
                 .collect())  # one row a node of this level
        shared.destroy()
        for r in found:
            trees.value[r.tree, r.node] = r.value
            if r.feature >= 0:
                trees.feature[r.tree, r.node], trees.bin[r.tree, r.node] = r.feature, r.bin
                trees.value[r.tree, 2 * r.node], trees.value[r.tree, 2 * r.node + 1] = r.left, r.right
        if not any(r.feature >= 0 for r in found):
            break
    shared = context.broadcast(trees)
    errors = (cells.mapInPandas(_errors(shared, plan, models, sizes), "model int, fold int, n double, error double")
              .groupBy("model", "fold").agg(F.sum("n").alias("n"), F.sum("error").alias("error")).collect())
    shared.destroy()
    discard(cells)
    mse = {(r.model, r.fold): r.error / r.n if r.n else math.nan for r in errors}
    return {name: [-mse.get((m, held), math.nan) for held in range(k)] for m, name in enumerate(specs)}
