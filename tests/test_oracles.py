"""Every registered key against its DuckDB oracle on the small driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import TABLES, rows_of

from delaykit.registry import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_key_has_oracle_or_is_model_key():
    assert set(QUERIES) - set(ORACLE) == {"train_select_best"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    got_cols, got = rows_of(QUERIES[key](spark, SF_SMALL).toPandas())
    exp_cols, exp = rows_of(con.sql(ORACLE[key]).df())
    assert got_cols == exp_cols
    assert got == exp


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "delay_minutes"]
    assert df.count() > 0
