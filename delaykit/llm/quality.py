"""Quality scores from preference pairs (Bradley-Terry) and a score quantile as the threshold.

A text's worth is a linear function of its features; the chance that one text is preferred to another is the logistic
function of the difference of their worths.  Pairs of a preferred (label 1) and a rejected (label 0) text give feature
differences, and the logistic loss on them is minimized by Newton steps, each one pass over the labelled rows.  Every
labelled row is learnt from: the rows are dealt into groups of bounded size by hash and paired inside a group, by the task
that holds it, so pairs are never stored.  The threshold is the quantile of all labelled rows' worths at the share of
rejected texts.  Features are computed in one pass over the texts, for the fit and the scores alike.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import crc_mod, texts_of
from delaykit.operators.ordering import row_index
from delaykit.session import materialize

PAIRS_EACH = 4
GROUP_ROWS, RARE_ROWS = 1024, 64  # rows of the commoner label that a group holds, and of the rarer one at least, about
PENALTY, STEPS = 1e-4, 60
THRESHOLD = 0.7
SHARES = 128  # byte shares come first
NAMES = [f"byte_{i}" for i in range(SHARES)] + ["non_ascii", "log_words", "word_length", "distinct_words", "distinct_lines",
                                               "capital_words", "symbol_words", "lone_symbols", "words_a_line", "top_word"]


def features(text: str | None) -> np.ndarray:
    """Of the whole text; an empty or null one is all zeros."""
    out = np.zeros(len(NAMES), np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    out[:SHARES] = np.sqrt(counts[:SHARES] / len(data))
    lines = data.split(b"\n")
    distinct = Counter(words)
    n = len(words)
    capital = sum(w.isupper() for w in words)
    symbols = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    lone = sum(len(w) == 1 and not w.isalnum() for w in words)
    out[SHARES:] = (counts[SHARES:].sum() / len(data), math.log1p(n) / 10, len(data) / n / 10, len(distinct) / n,
                    len(set(lines)) / len(lines), capital / n, symbols / n, lone / n, math.log1p(n / len(lines)) / 10,
                    max(distinct.values()) / n)
    return out


def features_udf():
    """The features as the bytes of their floats."""
    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t).tobytes() for t in texts], dtype=object)
    return of


def table_of(rows: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, len(NAMES))


@dataclass
class QualityModel:
    weights: np.ndarray
    cut: float
    threshold: float = THRESHOLD

    def scores(self, table: np.ndarray) -> np.ndarray:
        """0 to 1; ``threshold`` is the score at the quantile that separates the rejected share."""
        worth = np.clip(table.astype(np.float64) @ self.weights - self.cut, -30, 30)
        return 1 / (1 + np.exp(-worth) * (1 - self.threshold) / self.threshold)


def labelled_rows(known: DataFrame, labels: DataFrame, column: str, usable) -> DataFrame:
    """(doc_id, label, x): every labelled document for which ``usable`` (a condition on doc_id) holds; ``known``: (doc_id, x).
    Of several labels of one id the largest counts; null ids and null labels are left out, repeated rows count once."""
    given = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    return known.join(given, "doc_id").select("doc_id", "label", "x").distinct()


def grouped(rows: DataFrame, good: int, bad: int) -> DataFrame:
    """The rows of labels 1 and 0 with the ``group`` they are paired in.  Where the rarer label is too rare for every group to
    have some, its rows stand in several groups, so that no row of the commoner one is without a partner."""
    groups = 1 + (max(good, bad) - 1) // GROUP_ROWS
    copies = min(groups, 1 + (groups * RARE_ROWS - 1) // min(good, bad))
    rare = F.col("label") == (1 if good <= bad else 0)
    shift = F.explode(F.sequence(F.lit(0), F.when(rare, copies - 1).otherwise(0)))
    return rows.filter("label IN (0, 1)").select("*", shift.alias("copy")).select(
        "doc_id", "label", "x", F.pmod(F.pmod(F.xxhash64("doc_id", "x"), F.lit(groups)) + F.col("copy"), F.lit(groups)).alias("group"))


def group_pairs(label: np.ndarray, pairs_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the preferred and the rejected row of every pair of a group: each row of the commoner label is in
    ``pairs_each`` pairs, each other row in about as many as any of its kind."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    common, rare = (good, bad) if len(good) >= len(bad) else (bad, good)
    if not len(rare):
        return good[:0], bad[:0]
    turn, i = np.divmod(np.arange(pairs_each * len(common)), len(common))
    pair = common[i], rare[(i * 7919 + turn) % len(rare)]
    return pair if common is good else pair[::-1]


def _passes(rows: DataFrame, weights: np.ndarray, pairs_each: int) -> tuple[np.ndarray, ...]:
    """Over all pairs: their number and loss, the loss's gradient and Hessian, sums of the differences and of their squares."""
    k = len(weights)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, left = np.zeros(2 + 3 * k + k * k), None

        def add(group: pd.DataFrame) -> None:
            group = group.sort_values(["doc_id", "x"])
            good, bad = group_pairs(group["label"].to_numpy(), pairs_each)
            if not len(good):
                return
            x = table_of(group["x"]).astype(np.float64)
            d = x[good] - x[bad]
            z = d @ weights
            p = 1 / (1 + np.exp(np.clip(z, -700, 700)))  # chance of the other outcome
            total[:] += np.concatenate([[len(d), np.logaddexp(0, -z).sum()], -(p @ d), ((d * (p * (1 - p))[:, None]).T @ d).ravel(),
                                        d.sum(0), (d * d).sum(0)])

        for batch in batches:  # rows come by group; a group may go on in the next batch
            left = batch if left is None else pd.concat([left, batch])
            last = left["group"].iloc[-1] if len(left) else None
            for _, group in left[left["group"] != last].groupby("group"):
                add(group)
            left = left[left["group"] == last]
        if left is not None and len(left):
            add(left)
        yield pd.DataFrame({"at": np.arange(len(total)), "v": total})

    got = rows.mapInPandas(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(2 + 3 * k + k * k)
    out[got["at"].to_numpy()] = got["v"].to_numpy()
    return out[0], out[1], out[2:2 + k], out[2 + k:2 + k + k * k].reshape(k, k), out[-2 * k:-k], out[-k:]


def minimized(rows: DataFrame, pairs_each: int) -> np.ndarray:
    """Weights of least mean logistic loss of the pairs, with a penalty on the weights in standard units; ``rows`` come by
    group.  A step that makes the loss larger is halved."""
    weights = step = np.zeros(len(NAMES))
    scale, before = None, math.inf
    for _ in range(STEPS):
        n, loss, slope, curve, first, second = _passes(rows, weights, pairs_each)
        if scale is None:
            spread = np.sqrt(np.maximum(second - first * first / n, 0) / max(n - 1, 1))
            scale = np.where(spread > 1e-9, spread, np.inf)
        beta = np.where(np.isinf(scale), 0, weights * np.where(np.isinf(scale), 0, scale))
        loss = loss / n + PENALTY / 2 * beta @ beta
        if loss > before + 1e-12:
            step = step / 2
            if np.abs(step).max() < 1e-9:
                break
            weights = weights - step
            continue
        before = loss
        slope = slope / n / scale + PENALTY * beta
        curve = curve / n / np.outer(scale, scale) + PENALTY * np.eye(len(beta))
        move = np.linalg.solve(curve, -slope)
        if -slope @ move < 1e-9:  # what the step could gain, twice
            break
        step = move / scale
        weights = weights + step
    return weights


def fit(known: DataFrame, labels: DataFrame, usable, column: str = "quality",
        pairs_each: int = PAIRS_EACH, threshold: float = THRESHOLD) -> QualityModel:
    """Fits on all labelled rows that ``usable`` admits; ``known``: (doc_id, x).  Without both labels every text scores alike,
    above the threshold if label 1 is the one there is (or there is none)."""
    rows = materialize(labelled_rows(known, labels, column, usable), "quality")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = sizes.get(1, 0), sizes.get(0, 0)
    if not good or not bad:
        return QualityModel(np.zeros(len(NAMES)), -1.0 if good or not bad else 1.0, threshold)
    # One task a partition of groups: written in their order and not cut into splits, so a group stays whole.
    by_group = grouped(rows, good, bad)
    at = [F.col("group")]
    parts = 1 + (good + bad) // (16 * GROUP_ROWS)
    paired = materialize(by_group.repartition(parts, *at).sortWithinPartitions(*at), "pairs")
    weights = minimized(paired, pairs_each)
    model = QualityModel(weights, 0.0, threshold)

    @F.pandas_udf("double")
    def worth(x: pd.Series) -> pd.Series:
        return pd.Series(table_of(x).astype(np.float64) @ weights)

    model.cut = quantile(rows.filter("label IN (0, 1)").select(worth("x").alias("worth"), F.xxhash64("doc_id").alias("tie")),
                         ["worth", "tie"], bad / (good + bad), good + bad)
    return model


def quantile(df: DataFrame, order: list[str], share: float, n: int) -> float:
    """Exact, by a sort over all tasks: of the first column of ``order``, between the two rows next to ``share`` of the way
    from the first to the last of ``n``; the other columns tell equal values apart, so that many of them are shared out."""
    place = share * (n - 1)
    low = math.floor(place)
    found = row_index(df, order).filter(F.col("row_index").isin(low, low + 1)).collect()
    values = [r[order[0]] for r in sorted(found, key=lambda r: r.row_index)]
    return float(values[0] + (place - low) * (values[-1] - values[0]))


def score_udf(model: QualityModel):
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(table_of(x)), dtype="float64")
    return score


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, id_col: str = "doc_id",
            text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (crc32 of the id modulo ``folds`` is ``held``; such rows are never
    learnt from), ``score``, ``predicted``.  Null and empty texts get a score like any other; repeated rows repeat; a null
    id is scored, not learnt from; extra columns are ignored."""
    known = materialize(texts_of(docs, id_col, text_col).select("doc_id", features_udf()("text").alias("x")), "features")
    held_out = crc_mod("doc_id", folds) == held
    model = fit(known, labels, ~held_out, threshold=threshold)
    return (known.select("doc_id", held_out.alias("held_out"), score_udf(model)("x").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
