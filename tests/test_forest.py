"""Trees and forests scored on all folds together against Spark's own fits."""

import math
import random

import numpy as np
import pytest

from delaykit.plans import forest
from delaykit.plans import models as M

COLS = ["a", "b"]
SCHEMA = "a double, b double, delay_minutes double, fold int"
TREE, FOREST = forest.TREE, forest.FOREST


def _rows(n=900, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = float(rng.randint(0, 20)), rng.randint(0, 6) / 4
        out.append((a, b, 1e6 + 3 * a + (5.0 if b > 1 else 0.0) * a + rng.gauss(0, 4), i % 3))
    return out


def test_scores_equal_sparks_fits(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5).cache()
    specs = {TREE: {"maxDepth": 4, "minInstancesPerNode": 5, "seed": 42},
             FOREST: {"numTrees": 2, "maxDepth": 3, "featureSubsetStrategy": "all", "bootstrap": False, "seed": 42}}
    plain = {n: [M.fold_neg_mse(df, n, COLS, i, **p) for i in range(3)] for n, p in specs.items()}
    got = forest.fold_scores(df, COLS, specs)
    for name in specs:  # few values a feature: every cut between two values, as there
        assert got[name] == pytest.approx(plain[name], rel=1e-6)
    monkeypatch.setattr(forest, "CHUNK", 50)  # cells counted and handed on in parts
    monkeypatch.setattr(forest, "FLUSH", 20)
    monkeypatch.setattr(forest, "PER_BUCKET", 100)
    assert forest.fold_scores(df, COLS, {TREE: specs[TREE]})[TREE] == pytest.approx(plain[TREE], rel=1e-6)
    df.unpersist()


def test_bootstrap_forest_is_near_sparks(spark):
    df = spark.createDataFrame(_rows(1500), SCHEMA).repartition(3).cache()
    plain = [M.fold_neg_mse(df, FOREST, COLS, i) for i in range(3)]
    got = forest.fold_scores(df, COLS, {FOREST: M.DEFAULTS[FOREST]})[FOREST]
    assert got == pytest.approx(plain, rel=0.05) and got != pytest.approx(plain, rel=1e-9)  # samples are drawn
    assert forest.fold_scores(df, COLS, {FOREST: M.DEFAULTS[FOREST]})[FOREST] == pytest.approx(got, rel=1e-9)
    df.unpersist()


def test_default_models_are_not_fitted_fold_by_fold(spark, monkeypatch):
    df = spark.createDataFrame(_rows(300), SCHEMA)
    fitted, fit = [], M.fold_neg_mse
    monkeypatch.setattr(M, "fold_neg_mse", lambda t, name, *a, **o: fitted.append(name) or fit(t, name, *a, **o))
    scores = {r.model_name: r.score for r in M.score_models(spark, df, COLS).collect()}
    assert set(scores) == set(M.MODEL_NAMES) and not fitted
    assert scores[TREE] > scores["LinearRegression"]
    M.score_models(spark, df, COLS, [TREE], overrides={TREE: {"maxDepth": 13}}).collect()  # many levels: row by row
    assert fitted == [TREE] * 3


def test_what_is_scored_together():
    assert forest.fits(TREE, M.DEFAULTS[TREE], COLS) and forest.fits(FOREST, M.DEFAULTS[FOREST], COLS)
    assert not forest.fits(FOREST, {"numTrees": 5}, COLS)  # Spark's default takes some of the features
    assert not forest.fits(TREE, {"maxBins": 8}, COLS) and not forest.fits(TREE, {"missing": "skip"}, COLS)
    assert not forest.fits(TREE, {}, ["f"] * 5) and not forest.fits("LinearRegression", {}, COLS)


def test_missing_values_stop_and_empty_folds_have_no_score(spark):
    rows = _rows(90)
    for bad in [(None, 1.0, 1.0, 0), (1.0, float("nan"), 1.0, 0), (1.0, 1.0, None, 0)]:
        with pytest.raises(Exception, match="is missing"):
            forest.fold_scores(spark.createDataFrame([*rows, bad], SCHEMA), COLS, {TREE: {}})
    with pytest.raises(ValueError):
        forest.fold_scores(spark.createDataFrame([], SCHEMA), COLS, {TREE: {}})
    scores = forest.fold_scores(spark.createDataFrame([r for r in rows if r[3] != 1], SCHEMA), COLS, {TREE: {"maxDepth": 2}})[TREE]
    assert math.isnan(scores[1]) and scores[0] < 0 and scores[2] < 0


def test_cuts_lie_between_values_and_part_them_evenly():
    assert forest.cuts_of([1.0, 1.0, 2.0, 5.0]) == [1.5, 3.5] and forest.cuts_of([7.0] * 9) == []
    cuts = forest.cuts_of(np.arange(3200.0))
    assert len(cuts) == 31 and all(abs(c - 100 * (i + 1)) <= 1 for i, c in enumerate(cuts))


def test_short_and_long_time_texts_parse_alike(spark):
    from delaykit.functions.timefmt import parse_minute_text
    texts = ["2024-02-29T23:59", "2024-02-29 23:59Z", "2023-02-29T23:59", "2024-02-29T23:59:00", "2024-02-29T23:59:00.5Z", "2024-02-29T23:5",
             "2024-02-29T23:59+0100", "2024-02-29T23:59:0", "", None]
    rows = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_minute_text("t").cast("string")).collect()]
    at = "2024-02-29 23:59:00"
    assert rows == [at, at, None, at, at + ".5", None, "2024-02-29 22:59:00", None, None, None]
