"""Every registered query against its SQL, and the plans they run as."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from tests.check_queries import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = spark_entry.oracle_sql()
QUERIES = spark_entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert compare(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "key_frames", "master_maps", "align_rows", "enrich_left", "rescue_csv", "row_number_per_event",
    "path_metadata", "stage_counts", "profile_tables", "swing_features"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["align_rows"](spark, SF_DIR))
    assert "PushedFilters: [IsNull(_rescued_data)" in plan
    assert "Hips_R11" not in plan


@pytest.mark.parametrize("name", ["rescue_csv", "ingest_csv", "report_files"])
def test_lines_are_neither_shuffled_nor_sorted(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort [" not in plan


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert len(df.columns) == 475 and df.count() > 0
