"""Plan guards over every registered query: no cartesian product, no nested
loop join, no Python evaluation in the plan; filters reach the Parquet scan."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

from delaykit.registry import QUERIES  # noqa: E402
MODEL_KEYS = {"train_select_best"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - MODEL_KEYS))
def test_plan_has_no_cartesian_or_python(spark, key):
    text = plan_text(QUERIES[key](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in text, f"{key}: {bad} in plan"


def test_equality_filter_is_pushed_to_scan(spark):
    text = plan_text(QUERIES["filter_equals"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text


def test_projection_is_pruned_at_scan(spark):
    text = plan_text(QUERIES["missing_keys"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint>" in text


def test_keep_none_is_one_pass(spark):
    text = plan_text(QUERIES["keep_unique_keys"](spark, SF_SMALL))
    assert "Join" not in text and text.count("Scan parquet") <= 2  # tree and details


def test_insert_if_absent_groups_narrow_rows(spark):
    text = plan_text(QUERIES["insert_if_absent"](spark, SF_SMALL))
    assert "SortAggregate" not in text  # min_by over texts would need one


def test_day_numbering_windows_only_the_offsets(spark):
    text = plan_text(QUERIES["weather_request_batches"](spark, SF_SMALL))
    assert "row_number" not in text


def test_kfold_baseline_reads_its_rows_once(spark):
    text = plan_text(QUERIES["kfold_baseline_mse"](spark, SF_SMALL))
    assert "SortMergeJoin" not in text


def test_building_an_enrichment_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "building a plan")
    try:
        QUERIES["enrich_left_join"](spark, SF_SMALL)
        ran = [j for j in tracker.getJobIdsForGroup("build-only")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(ran) <= 2  # schema reads of the two files
