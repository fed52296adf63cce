"""Model choice, cross-validation, selection, refit, storage and scoring.

Models are ``pyspark.ml`` pipelines, so fitting and scoring run on the
executors.  Folds come from a column (``foldCol``) so that contiguous folds
over a stable order (the reference's unshuffled 3-fold) or hash folds (the
scalable default) are both possible.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, ImputerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.plans import forest, linear, trees

MODEL_NAMES = ("LinearRegression", "DecisionTreeRegressor", "RandomForestRegressor")

# What the models are unless a caller overrides it: ordinary least squares, a tree and a forest of sizes that
# distributed training handles at any number of rows (its passes grow with the nodes of a level).
DEFAULTS = {
    "LinearRegression": {"regParam": 0.0, "elasticNetParam": 0.0},
    "DecisionTreeRegressor": {"maxDepth": 10, "minInstancesPerNode": 1, "seed": 42},
    "RandomForestRegressor": {"numTrees": 20, "maxDepth": 8, "featureSubsetStrategy": "all",
                              "subsamplingRate": 1.0, "bootstrap": True, "seed": 42},
}

# Overrides for trees grown as deep as Spark allows and a forest of 100 of them, every feature at each split: the
# settings of single-node libraries, for small tables (see README for times).
DEEP = {
    "DecisionTreeRegressor": {"maxDepth": 30},
    "RandomForestRegressor": {"numTrees": 100, "maxDepth": 30},
}


def make_regressor(name: str, label_col: str = "delay_minutes", features_col: str = "features", **overrides):
    """The estimator for a model name; an unknown name is a ``ValueError`` (M4)."""
    classes = {"LinearRegression": LinearRegression, "DecisionTreeRegressor": DecisionTreeRegressor,
               "RandomForestRegressor": RandomForestRegressor}
    if name not in classes:
        raise ValueError(f"no model called {name!r}; expected one of {sorted(classes)}")
    params = {**DEFAULTS[name], **overrides}
    return classes[name](labelCol=label_col, featuresCol=features_col, **params)


MISSING = ("error", "impute", "skip")


def pipeline(name: str, feature_cols: Sequence[str], label_col: str = "delay_minutes", missing: str = "error",
             **overrides) -> Pipeline:
    """Assembler and estimator.  ``missing`` says what a NULL or NaN feature does: ``error`` stops the fit (the default:
    no row leaves unnoticed), ``impute`` puts the column's mean in its place, ``skip`` leaves the row out —
    ``missing_counts`` tells how many."""
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    columns, stages = list(feature_cols), []
    if missing == "impute":
        columns = [f"__imputed_{c}" for c in feature_cols]
        stages = [Imputer(inputCols=list(feature_cols), outputCols=columns, strategy="mean")]
    assembler = VectorAssembler(inputCols=columns, outputCol="features",
                                handleInvalid="skip" if missing == "skip" else "error")
    return Pipeline(stages=[*stages, assembler, make_regressor(name, label_col, **overrides)])


def is_missing(col) -> Column:
    """NULL or NaN."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | F.isnan(c.cast("double"))


def missing_counts(train: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_incomplete`` (rows with a missing feature) and the missing values of every feature."""
    some = F.lit(False)
    for c in feature_cols:
        some = some | is_missing(c)
    return train.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(some).alias("n_incomplete"),
                     *[F.count_if(is_missing(c)).alias(c) for c in feature_cols])


def fold_neg_mse(train: DataFrame, name: str, feature_cols: Sequence[str], fold: int,
                 label_col: str = "delay_minutes", fold_col: str = "fold", **overrides) -> float:
    """Fit on every fold but ``fold``, return the negative MSE on ``fold``."""
    fit_rows = train.filter(F.col(fold_col) != fold)
    test_rows = train.filter(F.col(fold_col) == fold)
    model = pipeline(name, feature_cols, label_col, **overrides).fit(fit_rows)
    evaluator = RegressionEvaluator(labelCol=label_col, predictionCol="prediction", metricName="mse")
    return -float(evaluator.evaluate(model.transform(test_rows)))


def cv_score(train: DataFrame, name: str, feature_cols: Sequence[str], label_col: str = "delay_minutes",
             fold_col: str = "fold", k: int = 3, **overrides) -> float:
    """Mean over the ``k`` folds of the negative MSE of ``name`` (M3), as
    ``cross_val_score(..., cv=k, scoring='neg_mean_squared_error').mean()``."""
    return sum(fold_neg_mse(train, name, feature_cols, i, label_col, fold_col, **overrides) for i in range(k)) / k


def _scans(name: str, options: dict) -> bool:
    """Whether a model is scored on all folds together: the tree, and least squares without penalty or imputed values."""
    plain = set(options) <= {"missing"} and options.get("missing") != "impute"
    return name == "HistogramTree" or (name == "LinearRegression" and plain)


def score_models(spark: SparkSession, train: DataFrame, feature_cols: Sequence[str],
                 names: Sequence[str] = MODEL_NAMES, label_col: str = "delay_minutes", fold_col: str = "fold",
                 overrides: dict | None = None, k: int = 3, parallelism: int = 9) -> DataFrame:
    """Cross-validated score of every model (M5).

    Plain least squares is scored on all folds by one scan (``plans.linear``), a ``HistogramTree`` by one scan a level
    for all folds (``plans.trees``; overrides: ``depth``, ``cuts``, ``min_rows``), trees and forests of few features and
    levels on all folds together by two scans (``plans.forest``).  The (model, fold) fits of the others
    are independent Spark jobs over the same (cached) training rows and run concurrently from a driver thread pool, so
    small jobs overlap instead of queueing.  Returns (model_name, position, score): one row per candidate model.
    """
    overrides = overrides or {}
    specs = {n: {**DEFAULTS.get(n, {}), **{o: v for o, v in overrides.get(n, {}).items() if (o, v) != ("missing", "error")}}
             for n in names}
    grown = {n: p for n, p in specs.items() if forest.fits(n, p, feature_cols)}
    tasks = [(n, i) for n in names if n not in grown for i in ([None] if _scans(n, overrides.get(n, {})) else range(k))]
    tasks += [(tuple(grown), None)] if grown else []

    def run(task):
        name, i = task
        if isinstance(name, tuple):
            return forest.fold_scores(train, feature_cols, grown, label_col, fold_col, k)
        options = overrides.get(name, {})
        if i is not None:
            return [fold_neg_mse(train, name, feature_cols, i, label_col, fold_col, **options)]
        if name == "HistogramTree":
            return list(trees.fold_scores(train, feature_cols, label_col, fold_col, k, **options).values())
        return list(linear.fold_scores(train, feature_cols, label_col, fold_col, options.get("missing", "error")).values())

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(run, tasks))
    per_model = {n: [] for n in names}
    for (name, _), scores in zip(tasks, results):
        for n, found in scores.items() if isinstance(name, tuple) else [(name, scores)]:
            per_model[n] += found
    rows = [(n, i, sum(per_model[n]) / k) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "model_name string, position int, score double")


def select_best(scores: DataFrame) -> DataFrame:
    """Scores with ``is_best``: highest score, ties to the first model listed."""
    best = (scores.filter(~F.isnan("score"))
                  .agg(F.min_by("model_name", F.struct(-F.col("score"), F.col("position"))).alias("__best")))
    return scores.withColumn("is_best", F.col("model_name") == best.select("__best").scalar())


def fit_best(train: DataFrame, name: str, feature_cols: Sequence[str], label_col: str = "delay_minutes",
             **overrides) -> PipelineModel:
    """Refit the chosen model on every training row (M5).

    The estimators make several passes (statistics, then the solve or one pass
    per tree level), so the training rows are persisted (memory, spilling to
    disk) for the duration of the fit instead of being recomputed per pass.
    """
    from pyspark import StorageLevel

    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline(name, feature_cols, label_col, **overrides).fit(cached)
    finally:
        cached.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    """Model sink (S15); ``path`` should be shared storage, not a local disk."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, features: DataFrame, feature_cols: Sequence[str],
            name: str = "prediction") -> DataFrame:
    """Score every row (M6).  A row with a NULL or NaN feature gets a NULL
    prediction instead of being dropped; a model fitted with ``missing="impute"`` predicts it from the column means."""
    complete = F.lit(True)
    for c in feature_cols:
        complete = complete & ~is_missing(c)
    kept = features.withColumn("__complete", complete).withColumn("__orig", F.struct(*feature_cols))
    if isinstance(model.stages[0], ImputerModel):
        kept = kept.withColumn("__complete", F.lit(True))
        scored = model.transform(kept).drop(*model.stages[0].getOutputCols())
    else:
        scored = model.transform(kept.fillna(0.0, subset=list(feature_cols)))
    restored = scored.withColumns({c: F.col(f"__orig.{c}") for c in feature_cols})
    return (restored.withColumn("__pred", F.when(F.col("__complete"), F.col("prediction")))
                    .drop("features", "__complete", "__orig", "prediction")
                    .withColumnRenamed("__pred", name))
