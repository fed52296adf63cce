"""The ledger of stored rows and joins whose hot keys are found."""

import uuid

import pytest
from pyspark.sql import functions as F

from delaykit.operators.incremental import new_rows_only
from delaykit.operators.joins import join_on_keys
from delaykit.operators.skew import hot_keys, join_hot_keys
from delaykit.sources.ledger import Ledger, row_hash
from delaykit.sources.sinks import append_rows

ROWS = [(1, "a", 1.0, "2024-01-01"), (1, "a", 1.0, "2024-01-01"), (2, None, 0.0, "2024-01-02"), (None, "b", float("nan"), None), (3, "c", None, "2024-01-03")]
MORE = [(1, "a", 1.0, "2024-01-01"), (2, None, -0.0, "2024-01-02"), (None, "b", float("nan"), None), (None, None, None, "2024-01-02"),
        (4, "new", 2.0, "2024-01-09"), (4, "new", 2.0, "2024-01-09"), (3, None, None, "2024-01-03")]
SCHEMA = "i int, s string, x double, day string"


@pytest.fixture()
def make(spark, tmp_path):
    names = []

    def build(**options):
        names.append("ledger_" + uuid.uuid4().hex)
        return Ledger(spark, names[-1], str(tmp_path / f"target{len(names)}"), buckets=4, path=str(tmp_path / f"ledger{len(names)}"), **options)
    yield build
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


@pytest.mark.parametrize("day", [None, "day"])
def test_append_equals_whole_row_comparison(spark, make, day):
    ledger = make(day=day)
    first, more = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(MORE, SCHEMA)
    assert ledger.append(first).count() == 5  # equal rows of one batch stay together
    expected = sorted(map(str, new_rows_only(more, first).collect()))
    assert sorted(map(str, ledger.append(more).collect())) == expected
    assert ledger.append(more).count() == 0 and ledger.append(first).count() == 0
    assert spark.read.parquet(ledger.target).count() == 5 + len(expected)
    assert ledger.rows().agg(F.sum("n")).first()[0] == 5 + len(expected)
    with pytest.raises(ValueError):
        ledger.append(more.select("s", "i", "x", "day"))


def test_stored_side_is_not_shuffled_and_only_its_days_are_read(spark, make):
    ledger = make(day="day")
    ledger.append(spark.createDataFrame(ROWS, SCHEMA))
    ledger.append(spark.createDataFrame(MORE, SCHEMA))
    plan = ledger.new_rows(spark.createDataFrame(MORE, SCHEMA), ["2024-01-09"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the batch's own
    scan = plan[plan.index("FileScan"):]
    assert "SelectedBucketsCount: 4 out of 4" in scan and "2024-01-09" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]


def test_ledger_is_rebuilt_after_a_run_that_died(spark, make):
    ledger = make(day="day")
    first, more = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(MORE, SCHEMA)
    ledger.append(first)
    append_rows(more, ledger.target)  # written to the target, not to the ledger
    assert not ledger.matches_target()
    assert ledger.append(more).count() == 0 and ledger.matches_target()


def test_buckets_grow_with_the_rows(spark, make, monkeypatch):
    monkeypatch.setattr("delaykit.sources.ledger.ROWS_A_BUCKET", 10)
    ledger = make(day="day")
    few, many = (spark.range(n).selectExpr("id", "concat('2024-01-0', 1 + id % 3) AS day") for n in (40, 150))
    assert ledger.append(few).count() == 40 and ledger.stored_buckets() == 4
    assert ledger.append(many).count() == 110 and ledger.stored_buckets() == 16
    assert ledger.append(many).count() == 0 and ledger.n_rows() == spark.read.parquet(ledger.target).distinct().count() == 150
    again = Ledger(spark, ledger.name, ledger.target, day="day", buckets=2, path=ledger.path)  # takes the stored number
    assert again.append(few).count() == 0 and again.buckets == 16
    batch = again.new_rows(many, ["2024-01-01"])
    assert max(r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect()) < 30  # of 100
    assert batch._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_row_hash_tells_rows_apart(spark):
    df = spark.createDataFrame([(None, 1, {"a": 1, "b": 2}), (1, None, {"b": 2, "a": 1}), (None, 1, {"b": 2, "a": 1})], "a int, b int, m map<string,int>")
    h = [r[0] for r in df.select(row_hash(df)).collect()]
    assert len(set(h)) == 2 and h[0] == h[2] and all(len(x) == 32 for x in h)


def test_hot_keys_are_found_exactly(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hub' WHEN id % 50 = 1 THEN 'mid' WHEN id % 7 = 2 THEN NULL "
                                        "ELSE concat('k', id) END AS k", "1 AS m").repartition(6)
    got = {(r.k, r.m): r.rows for r in hot_keys(df, ["k", "m"], 0.01).collect()}
    assert got == {("hub", 1): 10_000, ("mid", 1): 400}
    assert hot_keys(df.limit(0), ["k", "m"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_two_sided_hot_key_of_equal_rows_splits_evenly(spark, how):
    big = spark.range(4_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'hub' WHEN id % 11 = 1 THEN NULL ELSE concat('k', id % 50) END AS k", "7 AS v")
    other = spark.range(60).selectExpr("CASE WHEN id < 20 THEN 'hub' ELSE concat('k', id) END AS o", "id AS w")
    got = join_hot_keys(big, other, ["k"], ["o"], how, share=0.1, rows_a_task=250)
    assert got.columns == ["k", "v", "o", "w"]
    plain = join_on_keys(big, other, ["k"], ["o"], how)
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    tasks = [r["count"] for r in got.filter("k = 'hub'").groupBy(F.spark_partition_id()).count().collect()]
    plan = got._jdf.queryExecution().toString()
    assert sum(tasks) == 2_000 * 20 and "__salt" in plan
    with_position = join_hot_keys(big.withColumn("p", F.monotonically_increasing_id()), other, ["k"], ["o"], how, share=0.1, rows_a_task=250, position="p")
    assert with_position.count() == plain.count()
    # equal rows of the hot key are dealt evenly over the salts
    salts = [r["count"] for r in spark.range(2_000).groupBy(F.pmod(F.xxhash64("id"), F.lit(8))).count().collect()]
    assert len(salts) == 8 and max(salts) < 1.3 * min(salts)


def test_no_hot_key_is_a_plain_join(spark):
    big, other = spark.range(100).toDF("k"), spark.range(50).toDF("o")
    got = join_hot_keys(big, other, ["k"], ["o"])
    assert got.count() == 50 and "__salt" not in got._jdf.queryExecution().toString()
