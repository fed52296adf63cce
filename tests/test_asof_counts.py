"""As-of joins against a plain search, and counts that need no pass of their own."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from delaykit.operators.asof import asof_join
from delaykit.plans import ingest
from delaykit.plans.counts import RunCounts

T0 = dt.datetime(2024, 9, 6)


@pytest.mark.parametrize("hours", [None, 3])
def test_asof_equals_plain_search(spark, hours):
    rng = random.Random(8)
    at = lambda: T0 + dt.timedelta(hours=rng.randint(0, 40))
    key = lambda: rng.choice(["hub", "hub", "hub", "b", "c", None])
    left = [(i, key(), rng.choice([at(), at(), at(), None])) for i in range(300)]
    right = [(key(), rng.choice([at(), at(), at(), None]), float(rng.randint(0, 9)), i) for i in range(120)]
    within = None if hours is None else F.make_dt_interval(hours=F.lit(hours))
    got = asof_join(spark.createDataFrame(left, "id int, k string, t timestamp").repartition(7),
                    spark.createDataFrame(right, "k string, t timestamp, w double, n int").repartition(5), ["k"], ["k"], "t", "t", ["w", "n"], within)
    assert got.columns == ["id", "k", "t", "w", "n"]
    rows = {r.id: (r.w, r.n) for r in got.collect()}
    for i, k, t in left:
        found = [(rt, w, n) for rk, rt, w, n in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        best = max(found) if found else (None, None, None)
        if best[0] is not None and hours is not None and best[0] < t - dt.timedelta(hours=hours):
            best = (None, None, None)
        assert rows[i] == best[1:]
    assert got.filter("false").count() == 0 and len(rows) == 300


def test_counts_equal_a_second_pass_without_one(spark, tmp_path):
    page = {"FlightStatusResource": {"Flights": {"Flight": []}, "Meta": {"TotalCount": 0}}}
    pages = [{**page, "FlightStatusResource": {"n": k}} for k in range(5)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"metadata": {}, "data": [*pages, {"other": 1}]}))
    (tmp_path / "in" / "b.json").write_text(json.dumps({"metadata": {}, "data": pages[:2]}))
    (tmp_path / "in" / "cut.json").write_text('{"metadata": {}, "da')
    counts = RunCounts("ingest")
    added = ingest.store_raw_pages(spark, str(tmp_path / "in"), str(tmp_path / "store"), counts=counts)
    assert counts.values() == {("files", "rows"): 3, ("files", "unreadable"): 1, ("pages", "rows"): 8, ("pages", "unreadable"): 1,
                               ("added", "rows"): added.count()}
    counts.store(spark, str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    assert stored.filter("metric = 'unreadable'").agg(F.sum("value")).first()[0] == 2 and stored.select("run_id").distinct().count() == 1
