"""Every registered query against its SQL twin, and the shape of the plans that matter."""

from datetime import date

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES, events_tables
from spendlens.operators import allocate
from spendlens.plans import frames, questions, sql_functions, views

from .conftest import SMALL

# both sides may be empty on the smallest tables
_MAY_BE_EMPTY = {"user_table", "restrict_report", "restricted_user_breakdown", "billing_orphans",
                 "restricted_billing_orphans"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    difference = compare(spark, con, SMALL, name)
    if difference == "both are empty" and name in _MAY_BE_EMPTY:
        return
    assert difference is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_plan_crosses_or_runs_python(spark):
    T = events_tables(spark, SMALL)
    for view in views.VIEWS.values():
        plan = _plan(view(T))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_user_and_dates_reach_the_scans(spark):
    T = events_tables(spark, SMALL)
    plan = _plan(questions.user_breakdown(T, "User1", date(2024, 1, 5), date(2024, 1, 9)))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "/fact_" in line]
    assert len(scans) >= 1
    for scan in scans:
        assert "20240105" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
        assert "EqualTo(user_key,user1)" in scan


def test_arguments_of_sql_functions_reach_the_scans(spark):
    sql_functions.register_functions(events_tables(spark, SMALL), "2024-01-31")
    plan = _plan(spark.sql("SELECT * FROM user_exact_total('User1', DATE'2024-01-05', DATE'2024-01-09')"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "fact_premium_requests" in line)
    assert "20240105" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "EqualTo(user_key,user1)" in scan


def test_share_moves_each_fact_row_once(spark):
    T = events_tables(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(allocate.ide_share(T.fact_user_ide_day))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the rows, and their folded totals
    assert "Window" not in plan


def test_allocated_reports_fold_before_labels(spark):
    """Stored shares leave two joins below the fan-out, and a report's rollup sees folded rows."""
    T = events_tables(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(frames.detail_matrix(T))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expand = plan.index("Expand")
    assert "fact_user_model_feature_day" not in plan and "HashAggregate" in plan[expand:]
