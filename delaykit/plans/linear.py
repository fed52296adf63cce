"""Cross-validation of a linear model in one scan (M3, M5).

Least squares needs only sums of products, and sums of "all rows but one fold" are differences: one aggregate per fold
(combined map-side) gives the sums of every product of two columns; each fold's model is solved from the total minus the
fold's own sums, and its squared error on the fold expands into the fold's sums.  ``k`` fits and ``k`` scorings are one scan
of the training rows, whatever ``k``; the driver sees ``k`` rows of (features + 2)^2 / 2 numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRODUCTS = 1000  # sums in one aggregate; more columns take one scan for every thousand products


def fold_sums(train: DataFrame, feature_cols: Sequence[str], label_col: str = "delay_minutes", fold_col: str = "fold",
              shift: Sequence[float] | None = None) -> dict[int, np.ndarray]:
    """Per fold the matrix of sums of products of (1, features, label), every column less its ``shift`` (a value near its
    middle keeps the sums small against the spread; any value gives the same models)."""
    names = [*feature_cols, label_col]
    shift = [0.0] * len(names) if shift is None else list(shift)
    one = F.lit(1.0)
    values = [one, *[F.col(f"`{c}`").cast("double") - F.lit(float(s)) for c, s in zip(names, shift)]]
    pairs = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
    out: dict[int, np.ndarray] = {}
    for at in range(0, len(pairs), PRODUCTS):
        part = pairs[at:at + PRODUCTS]
        sums = [F.sum(values[i] * values[j]).alias(f"s{n}") for n, (i, j) in enumerate(part)]
        for row in train.groupBy(F.col(fold_col).alias("__fold")).agg(*sums).collect():  # one row a fold
            gram = out.setdefault(row["__fold"], np.zeros((len(values), len(values))))
            for n, (i, j) in enumerate(part):
                gram[i, j] = gram[j, i] = row[f"s{n}"]
    return out


def solve(gram: np.ndarray) -> np.ndarray:
    """Intercept and coefficients of least squares from the sums of products; among equally good ones (linearly dependent
    or constant columns) the smallest in standard units."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    cov = gram[1:, 1:] / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov)[:-1], 0.0))
    scale = np.where(spread > 1e-9 * (1 + np.abs(mean[:-1])), spread, np.inf)  # a constant column has no coefficient
    standard = cov[:-1, :-1] / np.outer(scale, scale)
    coef = np.linalg.lstsq(standard, cov[:-1, -1] / scale, rcond=1e-10)[0] / scale
    return np.concatenate([[mean[-1] - coef @ mean[:-1]], coef])


def squared_error(gram: np.ndarray, model: np.ndarray) -> float:
    """Mean squared error of a model on the rows behind the sums."""
    v = np.concatenate([model, [-1.0]])
    return float(max(v @ gram @ v, 0.0) / gram[0, 0])


def fold_scores(train: DataFrame, feature_cols: Sequence[str], label_col: str = "delay_minutes", fold_col: str = "fold",
                missing: str = "error") -> dict[int, float]:
    """Negative mean squared error on every fold of the model fitted on the others.

    ``missing``: ``skip`` leaves rows with a NULL or NaN feature out, ``error`` stops (as ``models.pipeline`` does)."""
    from delaykit.plans.models import is_missing

    columns = [*feature_cols, label_col]
    gap = reduce(lambda a, b: a | b, [is_missing(f"`{c}`") for c in feature_cols], F.lit(False))
    if missing == "skip":
        train = train.filter(~gap)
    elif missing != "error":
        raise ValueError("one scan can't impute: the means differ from fold to fold")
    first = train.select(*[F.col(f"`{c}`").cast("double") for c in columns]).first()
    if first is None:
        return {}
    shift = [0.0 if v is None or np.isnan(v) else v for v in first]
    rows = train if missing == "skip" else _checked(train, feature_cols, gap)
    grams = fold_sums(rows, feature_cols, label_col, fold_col, shift)
    total = sum(grams.values())
    return {fold: -squared_error(gram, solve(total - gram)) for fold, gram in sorted(grams.items())}


def _checked(train: DataFrame, feature_cols: Sequence[str], gap) -> DataFrame:
    """The rows, with an error in place of the first feature of an incomplete row."""
    first = feature_cols[0]
    message = F.raise_error(F.lit("a feature is missing; choose missing='skip' or 'impute'")).cast("double")
    return train.withColumn(first, F.when(gap, message).otherwise(F.col(f"`{first}`").cast("double")))
