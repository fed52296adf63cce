"""Joins (J1-J10).

Join strategy is left to Catalyst + AQE: a side that turns out small in bytes
is broadcast at run time, a hot key's partition is split.  No hint is given
here, so a plan never depends on a count taken while it is being built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_condition(left: DataFrame, right: DataFrame, left_cols: Sequence[str],
                        right_cols: Sequence[str]):
    cond = None
    for lc, rc in zip(left_cols, right_cols):
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def enrich(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           dim_cols: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Left-join a dimension projected to its key + ``dim_cols``, then drop rows
    with NULL in ``required`` (J1).

    With the key among ``required`` Catalyst rewrites the outer join into an
    inner one.  Duplicated dimension keys fan out, as they do in the reference.
    """
    right = dim.select(F.col(dim_key).alias("__dim_key"), *dim_cols)
    out = facts.join(right, facts[fact_key] == right["__dim_key"], "left").drop("__dim_key")
    if required:
        cond = F.lit(True)
        for c in required:
            cond = cond & F.col(c).isNotNull()
        out = out.filter(cond)
    return out


def distinct_then_enrich(facts: DataFrame, cols: Sequence[str], fact_key: str, dim: DataFrame,
                         dim_key: str, dim_cols: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Project to ``cols``, de-duplicate, then ``enrich``.

    The distinct is a partial (map-side) aggregate, so a hot value is collapsed
    before the shuffle.
    """
    return enrich(facts.select(*cols).distinct(), dim, fact_key, dim_key, dim_cols, required)


def join_on_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                 right_keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on several keys (J4); duplicates on either side fan out.

    Plain equality: NULL keys never match (they would be useless matches).
    """
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def missing_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key has no match in ``right``."""
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    return left.join(keys, left[left_key] == keys["__k"], "left_anti")


def first_per_key(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                  value_cols: Sequence[str]) -> DataFrame:
    """One row per key: the one smallest in ``order_cols`` (first match).

    A ``min_by`` aggregate (partial aggregation on the map side) instead of a
    ``row_number`` window, so a key holding a third of the rows is reduced in
    every task before the shuffle rather than sorted in one task.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in value_cols])
    return (df.groupBy(*key_cols)
              .agg(F.min_by(payload, order).alias("__first"))
              .select(*key_cols, *[F.col(f"__first.{c}").alias(c) for c in value_cols]))


def lookup_or_null(requests: DataFrame, dim: DataFrame, request_key: str, dim_key: str,
                   order_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Point lookup as a left join (J7): the first dimension row per key or NULLs."""
    firsts = first_per_key(dim, [dim_key], order_cols, value_cols)
    firsts = firsts.withColumnRenamed(dim_key, "__lk")
    return requests.join(firsts, requests[request_key] == firsts["__lk"], "left").drop("__lk")


def zip_checked(df: DataFrame, keep: Sequence[str], arrays: dict[str, str]) -> DataFrame:
    """Parallel arrays as rows (J8): ``arrays`` maps result names to array columns; adds ``pos`` from 0.

    Arrays of one row must have equal lengths; a difference is an error that names the lengths, never a
    silent padding with NULLs.  A row whose arrays are all empty, or all NULL, gives no rows."""
    cols = list(arrays.values())
    sizes = [F.coalesce(F.size(c), F.lit(-1)) for c in cols]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    message = F.concat(F.lit("arrays to zip differ in length: "), F.concat_ws(", ", *[s.cast("string") for s in sizes]))
    zipped = F.arrays_zip(*[F.col(c).alias(f"__{i}") for i, c in enumerate(cols)])
    names = df.select(zipped.alias("z")).schema["z"].dataType.elementType.names
    rows = df.select(*keep, F.posexplode(F.when(same, zipped).otherwise(F.raise_error(message))).alias("pos", "__z"))
    return rows.select(*keep, "pos", *[F.col(f"__z.`{n}`").alias(out) for n, out in zip(names, arrays)])


def salted_join(big: DataFrame, other: DataFrame, big_keys: Sequence[str], other_keys: Sequence[str],
                buckets: int, how: str = "inner") -> DataFrame:
    """Equi-join that spreads every key over ``buckets`` tasks (skew salting).

    The big side gets a salt derived from a hash of its own row (deterministic:
    a recomputed task after an executor loss assigns the same salt, which a
    ``rand()`` salt would not); the other side is replicated once per salt
    value.  Use when one key holds a large share of *both* sides, where
    splitting one side (AQE's skew join) is not enough.  ``how`` is ``inner``
    or ``left`` (the big side is the preserved one).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports 'inner' and 'left'")
    if buckets <= 1:
        return join_on_keys(big, other, big_keys, other_keys, how)
    salted_big = big.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets)))
    salted_other = other.withColumn("__salt_o", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    cond = salted_big["__salt"] == salted_other["__salt_o"]
    for bk, ok in zip(big_keys, other_keys):
        cond = cond & (salted_big[bk] == salted_other[ok])
    return salted_big.join(salted_other, cond, how).drop("__salt", "__salt_o")
