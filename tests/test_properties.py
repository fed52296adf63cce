"""Property tests (hypothesis) on small generated frames: algebraic laws of the
incremental and nested operators."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delaykit.operators.dedup import keep_unique_keys
from delaykit.operators.incremental import new_rows_only
from delaykit.operators.nested import collect_nested

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from("ab"))),
                max_size=12)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


@SETTINGS
@given(new=ROWS, old=ROWS)
def test_new_rows_only_matches_pandas_merge_and_is_idempotent(spark, new, old):
    import pandas as pd
    got = sorted(new_rows_only(_df(spark, new), _df(spark, old)).collect(), key=repr)
    # frame-merge reference: left merge on all columns with indicator, keep left_only (NaN matches NaN)
    left = pd.DataFrame(new, columns=["k", "v"], dtype=object)
    right = pd.DataFrame(old, columns=["k", "v"], dtype=object).drop_duplicates()
    merged = left.merge(right, on=["k", "v"], how="left", indicator=True)
    exp = [tuple(None if pd.isna(x) else x for x in r) for r in merged[merged["_merge"] == "left_only"][["k", "v"]].itertuples(index=False)]
    assert sorted(map(tuple, got), key=repr) == sorted(exp, key=repr)
    stored = _df(spark, old).unionByName(new_rows_only(_df(spark, new), _df(spark, old)))
    assert new_rows_only(_df(spark, new), stored).count() == 0


@SETTINGS
@given(rows=ROWS)
def test_keep_unique_plus_removed_is_input(spark, rows):
    df = _df(spark, rows)
    kept = keep_unique_keys(df, ["k"])
    removed = df.join(kept.select("k").withColumnRenamed("k", "kk"), F.col("k").eqNullSafe(F.col("kk")), "left_anti")
    assert kept.count() + removed.count() == len(rows)
    assert sorted(map(tuple, kept.unionByName(removed).collect()), key=repr) == sorted(rows, key=repr)


@SETTINGS
@given(items=st.lists(st.tuples(st.integers(0, 3), st.text(alphabet="xyz", max_size=3)), max_size=15))
def test_collect_then_explode_is_identity(spark, items):
    rows = [(g, i, t) for i, (g, t) in enumerate(items)]
    df = spark.createDataFrame(rows, "g int, pos int, t string")
    nested = collect_nested(df, ["g"], "pos", ["pos", "t"], "items")
    back = nested.select("g", F.inline("items"))
    assert sorted(map(tuple, back.select("g", "pos", "t").collect())) == sorted(rows)
