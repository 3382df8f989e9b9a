"""Driver contract: flagship runs, every registered query runs on sf0.001, oracle keys
match, and the plans avoid the slow paths."""

import pytest

import __spark_entry__ as E
from staygrid.oracle import queries_sql
from staygrid.registry import registry
from conftest import SF_SMALL

ROWS_ONLY = {"radius_cells", "cover_extent", "column_profile_approx"}
OWN = registry()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["rank", "hotel_id", "hotel_name", "max_tmpr_c_diff"]


def test_oracle_covers_every_query_but_rows_only():
    assert set(OWN) - set(queries_sql()) == ROWS_ONLY
    assert set(queries_sql()) <= set(OWN)
    assert set(OWN) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_runs_without_python_rows_or_cartesian(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan          # no row-at-a-time Python UDF
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_top_k_is_planned_as_window_group_limit(spark):
    plan = E.queries()["busy_hotels"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
