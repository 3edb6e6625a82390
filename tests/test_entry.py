"""Every registered query against its DuckDB oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(SF)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_difference_sees_differences(spark, con):
    df = spark.read.parquet(f"{SF}/nation.parquet").select("n_nationkey", "n_name")
    assert difference(df, con, "select n_nationkey, n_name from nation") is None
    assert difference(df, con, "select n_nationkey, upper(n_name) || 'x' as n_name from nation") is not None
    assert difference(df, con, "select n_nationkey, n_name from nation limit 3") is not None
    assert difference(df, con, "select cast(n_nationkey as smallint) as n_nationkey, n_name from nation") is not None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["session_key", "parameter", "n_samples", "n_valid", "min_value", "max_value", "mean_value"]
    assert df.count() > 0
