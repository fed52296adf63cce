"""Cross-validation by sums and histogram trees against plain versions on the driver."""

import random

import numpy as np
import pytest

from delaykit.plans import linear, trees
from delaykit.plans import models as M


def _rows(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.uniform(1e5, 1e5 + 10), float(rng.randint(0, 4)), rng.gauss(0, 1)
        out.append((a, b, c, 2 * a - b + (3.0 if c > 0 else 0.0) + rng.gauss(0, .5), i % 3))
    return out


COLS = ["a", "b", "c"]
SCHEMA = "a double, b double, c double, delay_minutes double, fold int"


def _plain_scores(rows, cols):
    data = np.array([[r[i] for i in cols] for r in rows])
    y, fold = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    out = {}
    for k in range(3):
        x = np.column_stack([np.ones(len(y)), data - data.mean(0)])
        coef = np.linalg.lstsq(x[fold != k], y[fold != k], rcond=None)[0]
        out[k] = -float(np.mean((y[fold == k] - x[fold == k] @ coef) ** 2))
    return out


def test_one_scan_equals_fold_by_fold(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    plain = _plain_scores(rows, [0, 1, 2])
    assert linear.fold_scores(df, COLS) == pytest.approx(plain, rel=1e-6)
    monkeypatch.setattr(linear, "PRODUCTS", 4)  # the products in several scans
    assert linear.fold_scores(df, COLS) == pytest.approx(plain, rel=1e-6)
    # equal and constant columns have no solution of their own, but the same predictions
    wide = df.selectExpr("*", "a AS a2", "7.0D AS one")
    assert linear.fold_scores(wide, [*COLS, "a2", "one"]) == pytest.approx(plain, rel=1e-6)
    spark_ml = [M.fold_neg_mse(df, "LinearRegression", COLS, i) for i in range(3)]
    assert [linear.fold_scores(df, COLS)[i] for i in range(3)] == pytest.approx(spark_ml, rel=1e-5)


def test_missing_features_in_one_scan(spark):
    rows = [*_rows(90), (None, 1.0, 1.0, 5.0, 0), (1.0, float("nan"), 1.0, 5.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="a feature is missing"):
        linear.fold_scores(df, COLS)
    assert linear.fold_scores(df, COLS, missing="skip") == pytest.approx(_plain_scores(rows[:90], [0, 1, 2]), rel=1e-6)
    with pytest.raises(ValueError):
        linear.fold_scores(df, COLS, missing="impute")
    assert linear.fold_scores(df.limit(0), COLS) == {}


def _plain_tree(rows, cuts, depth, node=1):
    y = [round(r[3], 6) for r in rows]
    out = {node: (None, None, len(y), sum(y) / len(y))}
    best = None
    for i, c in enumerate(COLS):
        for cut in cuts.get(c, []):
            left = [v for v, r in zip(y, rows) if r[i] <= cut]
            n, s = len(left), sum(left)
            if 0 < n < len(y):
                gain = s * s / n + (sum(y) - s) ** 2 / (len(y) - n) - sum(y) ** 2 / len(y)
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12)):
                    best = (gain, i, c, cut)
    if depth and best:
        _, i, c, cut = best
        out[node] = (c, cut, *out[node][2:])
        out |= _plain_tree([r for r in rows if r[i] <= cut], cuts, depth - 1, 2 * node)
        out |= _plain_tree([r for r in rows if r[i] > cut], cuts, depth - 1, 2 * node + 1)
    return out


def test_tree_equals_plain_growth_whatever_the_partitions(spark):
    rows = _rows(200, 3)
    cuts = {"a": [1e5 + 3, 1e5 + 6], "b": [0.0, 1.0, 2.0], "c": [-0.5, 0.0, 0.5]}
    plain = _plain_tree(rows, cuts, 3)
    for parts in (1, 7):
        tree = trees.grow(spark.createDataFrame(rows, SCHEMA).repartition(parts), COLS, depth=3, cuts=cuts)[0]
        got = {n: rest for n, *rest in tree.rows()}
        assert got.keys() == plain.keys()
        for n, (feature, cut, size, value) in plain.items():
            assert got[n][:3] == [feature, cut, size] and got[n][3] == pytest.approx(value, rel=1e-9)


def test_trees_of_all_folds_grow_together(spark):
    rows = _rows(150, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = {"a": [1e5 + 5], "c": [0.0]}
    together = trees.grow(df, COLS, depth=2, cuts=cuts, fold_col="fold", folds=range(3))
    scores = trees.fold_scores(df, COLS, depth=2, cuts=cuts)
    for k in range(3):
        alone = trees.grow(df.filter(f"fold <> {k}"), COLS, depth=2, cuts=cuts)[0]
        assert together[k].rows() == alone.rows()
        guess = df.filter(f"fold = {k}").select("delay_minutes", alone.prediction().alias("p")).collect()
        assert scores[k] == pytest.approx(-np.mean([(r.delay_minutes - r.p) ** 2 for r in guess]), rel=1e-9)


def test_rows_are_counted_once_for_all_levels(spark, monkeypatch):
    df = spark.range(600).selectExpr("id * 1.0 AS a", "id % 7 * 1.0 AS b", "id % 11 * 1.5 AS delay_minutes", "CAST(id % 3 AS INT) AS fold")
    cuts = {"a": [100.0, 300.0], "b": [1.0, 3.0, 4.0]}
    sizes, best = [], trees._best_splits

    def counted(sums, min_rows):
        sizes.append(sums._jdf.queryExecution().optimizedPlan().toString().count("delay_minutes"))
        return best(sums, min_rows)

    monkeypatch.setattr(trees, "_best_splits", counted)
    few = trees.grow(df, ["a", "b"], depth=3, cuts=cuts, fold_col="fold", folds=range(3))
    assert len(sizes) > 2 and not any(sizes)  # no level reads the rows
    monkeypatch.setattr(trees, "GRID", 1)
    each = trees.grow(df, ["a", "b"], depth=3, cuts=cuts, fold_col="fold", folds=range(3))
    assert few == each


def test_cuts_part_the_rows_evenly(spark):
    df = spark.range(10_000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS few", "1.0D AS one",
                                        "CASE WHEN id < 5000 THEN 0.0D ELSE CAST(id AS DOUBLE) END AS heavy")
    cuts = trees.equal_frequency_cuts(df, ["x", "few", "one", "heavy"], bins=8)
    assert len(cuts["x"]) == 7 and all(abs(c - 1250 * (i + 1)) < 6 for i, c in enumerate(cuts["x"]))
    assert len(cuts["few"]) == 2 and 0 < cuts["few"][0] < 1 < cuts["few"][1] < 2
    assert cuts["one"] == [] and len(cuts["heavy"]) == 4 and 0 < cuts["heavy"][0] < 5000
    empty = trees.grow(df.limit(0).selectExpr("x", "few", "x AS delay_minutes"), ["x", "few"])[0]
    assert empty.rows() == []
