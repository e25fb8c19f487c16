"""The registered queries: equal to their SQL, and planned as intended."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

DATA = "/root/testdata/sf0.001"
PLANNED = ["alight_candidates", "alight_fallback", "near_sites", "transfer_pairs", "journeys", "od_bus_rail_day", "od_month"]


@pytest.fixture(scope="module")
def db() -> duckdb.DuckDBPyConnection:
    return connect(DATA)


def test_every_query_has_its_sql():
    assert list(entry.transit_queries()) == list(entry.transit_sql())


@pytest.mark.parametrize("name", list(entry.transit_queries()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, DATA, name).startswith("ok")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_products_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, DATA))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_scans_read_only_what_they_use(spark):
    plan = plan_of(entry.queries()["gps_clean"](spark, DATA))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
    assert "PushedFilters: [In(event_type, [click,view])" in plan


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_runs_need_two_exchanges(spark):
    """One for the pre-aggregated fixes, one for the vehicle's visits and runs."""
    assert exchanges(entry.queries()["gps_run_fixes"](spark, DATA)) == 2


def test_labels_and_journeys_need_one_exchange(spark):
    from tests.frames import leg, legs

    from tapflow.operators.journeys import journeys
    from tapflow.operators.transfers import transfer_labels, transfer_pairs

    table = legs(spark, [leg(0, 1, "A")])
    assert [exchanges(step(table)) for step in (transfer_labels, transfer_pairs, journeys)] == [1, 1, 1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
