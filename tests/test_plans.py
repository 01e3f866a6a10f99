"""Physical plans that must hold at any size."""

import pytest

from civiclens.operators import facts, reports
from civiclens.plans.catalog import QUERIES, run
from civiclens.plans.workspace import DIMENSIONS

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
WRITES_FILES = {"ingest_append", "resumable_ingest", "aligned_append", "csv_roundtrip"}
TRAINS = {"model_benchmark", "closure_regression"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FILES - TRAINS))
def test_no_cross_joins_and_no_python_rows(name, spark, folder):
    plan = plan_of(run(name, spark, folder))
    assert [operator for operator in FORBIDDEN if operator in plan] == []


def test_window_extract_reaches_the_scan(spark, folder):
    plan = plan_of(run("window_extract", spark, folder))
    assert "GreaterThanOrEqual(created_date,1995-03-01T00:00:00.000)" in plan
    assert "ReadSchema: struct<sr_number:string,sr_type:string,status:string,created_date:string>" in plan


def test_reports_read_one_column(spark, folder):
    assert "ReadSchema: struct<service_id:bigint>" in plan_of(run("top_10_services", spark, folder))
    assert "TakeOrderedAndProject" in plan_of(run("top_10_services", spark, folder))


def test_flagship_counts_before_it_joins(spark, folder):
    plan = plan_of(run("join_service_department", spark, folder))
    join = plan.rindex("Join")
    assert "partial_count(1)" in plan[join:]


def test_validation_reads_the_fact_twice(spark, folder):
    plan = run("validation_report", spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line and "fact_id#" in line]
    assert len(scans) == 2


def test_months_read_no_fact_column(spark, folder):
    plan = plan_of(run("requests_by_month", spark, folder))
    assert "ReadSchema: struct<>" in plan


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run when a dimension outgrows the broadcast threshold."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set(key, old)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_star_is_the_same_without_broadcasts(ws, no_broadcast):
    built = ws.table("fact_star")
    again = facts.fact_star(ws.requests, *[ws.table(d) for d in DIMENSIONS])
    plan = plan_of(again)
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert again.exceptAll(built).count() == built.exceptAll(again).count() == 0


def test_flagship_is_the_same_without_broadcasts(ws, spark, folder, no_broadcast):
    pairs = reports.service_department_pairs(
        ws.table("fact_requests"), ws.table("dim_service"), ws.table("dim_department")
    )
    assert "SortMergeJoin" in plan_of(pairs)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert pairs.collect() == run("join_service_department", spark, folder).collect()
