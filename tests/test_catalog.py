"""Every query beside its SQL oracle, and the plans of the main ones."""

from __future__ import annotations

import pytest
from check_oracles import compare, database

from faultline import catalog

SF = "/root/testdata/sf0.001"
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(catalog.queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    df = catalog.queries()[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare(df, db, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["numeric_summary_bucketed", "ranking_bucketed"])
def test_large_way_has_no_single_task_over_values(spark, name):
    """Values are exchanged by group and bucket, never into a single partition."""
    plan = plan_of(catalog.queries()[name](spark, SF))
    lines = [x for x in plan.splitlines() if "SinglePartition" in x]
    assert not lines


def test_sweep_reads_two_columns_and_shuffles_counts(spark):
    plan = plan_of(catalog.queries()["threshold_sweep_by_user"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert plan.count("FileScan") == 1 and "Window" not in plan


def test_error_cases_need_no_shuffle(spark):
    plan = plan_of(catalog.queries()["error_cases"](spark, SF))
    assert "Exchange" not in plan and "Join" not in plan
