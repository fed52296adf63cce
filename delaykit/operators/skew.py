"""Joins whose hot keys are found, not given.

A frequent-items sketch (``approx_top_k``, built map-side) names the keys that may hold a large share of the rows and an
exact count of just those settles it.  Only their rows are salted, by position rather than by content, so that equal rows
spread too, and only their partners are replicated; all other keys join as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.operators.joins import join_on_keys
from delaykit.session import materialize

SHARE = 0.01  # of the rows, from which on a key is hot: so at most 1 / SHARE keys are


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of the rows of ``df``, with their ``rows``: at most 1 / ``share`` keys.

    The sketch tracks ten times as many items as there can be hot keys, so its error is below a tenth of a hot key's rows
    and none is missed; its candidates are counted exactly.  NULL keys match nothing and are never hot."""
    known = df.dropna(subset=list(keys)).select(F.xxhash64(*keys).alias("__key"), *keys)
    most = max(1, int(1 / share))
    tracked = 1 << max(6, (20 * most - 1).bit_length())
    sketch = known.agg(F.expr(f"approx_top_k(__key, {min(2 * most, tracked)}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    candidates = [r["item"] for r in sketch["top"] or []]  # at most 2 / share numbers
    if not candidates:
        return known.select(*keys).limit(0).withColumn("rows", F.lit(0).cast("long"))
    return (known.filter(F.col("__key").isin(candidates)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
                 .filter(F.col("rows") >= F.greatest(F.lit(2), F.ceil(F.lit(share * sketch["n"])))))


def join_hot_keys(big: DataFrame, other: DataFrame, big_keys: Sequence[str], other_keys: Sequence[str], how: str = "inner",
                  share: float = SHARE, rows_a_task: int = 1_000_000, position: str | None = None) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big`` over tasks of about ``rows_a_task`` rows (``how``: inner or left).

    The rows of hot keys get a salt from their position: of the column ``position`` if given (whole numbers, unique or
    evenly spread), else of a number given when those rows are written once (a recomputed task must not number them anew).
    Partners of a hot key are replicated once for each of its salts.  Broadcast are only the hot keys, at most 1 / ``share``
    rows."""
    if how not in ("inner", "left"):
        raise ValueError("join_hot_keys supports 'inner' and 'left'")
    names = [f"__k{i}" for i in range(len(big_keys))]
    found = hot_keys(big, big_keys, share).select(*[F.col(k).alias(n) for k, n in zip(big_keys, names)],
                                                  F.ceil(F.col("rows") / rows_a_task).cast("int").alias("__salts"))
    hot = materialize(found.filter("__salts > 1"), "hot-keys")
    if hot.isEmpty():
        return join_on_keys(big, other, big_keys, other_keys, how)

    def split(df, keys):
        same = [df[k] == hot[n] for k, n in zip(keys, names)]
        marked = F.broadcast(hot)
        return df.join(marked, same, "left_anti"), df.join(marked, same, "inner").drop(*names)

    cold, warm = split(big, big_keys)
    cold_other, warm_other = split(other, other_keys)
    if position is None:
        warm = materialize(warm.withColumn("__position", F.monotonically_increasing_id()), "hot-rows")
    else:
        warm = warm.withColumn("__position", F.col(position))
    salted = warm.withColumn("__salt", F.pmod(F.xxhash64("__position"), "__salts").cast("int")).drop("__position", "__salts")
    copies = warm_other.withColumn("__salt_o", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    cond = salted["__salt"] == copies["__salt_o"]
    for b, o in zip(big_keys, other_keys):
        cond = cond & (salted[b] == copies[o])
    spread = salted.join(copies, cond, how).drop("__salt", "__salt_o")
    return join_on_keys(cold, cold_other, big_keys, other_keys, how).unionByName(spread)
