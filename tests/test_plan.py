from pyspark.sql import functions as F

from tests.frames import rows_of

from tapflow.operators.alighting import nearby_stops
from tapflow.plans.day import OdPlan
from tapflow.plans.network import Network
from tapflow.sources.event_tables import EventTables

DATA = "/root/testdata/sf0.001"


def test_whole_plan_with_hot_persons(spark):
    """Part of the persons taken as hot: same legs, transfers and journeys."""
    tables = EventTables(spark, DATA)
    network = Network(tables.bus_sites, tables.rail_sites)

    def plan(**options):
        return OdPlan(tables.taps, tables.gps_fixes, network, tables.gates, **options)

    usual, split = plan(), plan(hot_rows=38)
    assert usual.hot_persons is None
    assert 0 < split.hot_persons.count() < 15
    assert rows_of(split.labelled) == rows_of(usual.labelled)
    assert rows_of(split.transfers) == rows_of(usual.transfers)
    assert rows_of(split.journeys) == rows_of(usual.journeys)


def test_hot_persons_do_not_make_the_rows_twice(spark):
    """Ordinary and hot rows are read from one table: the feeds don't take part again."""
    tables = EventTables(spark, DATA)
    plan = OdPlan(tables.taps, tables.gps_fixes, Network(tables.bus_sites, tables.rail_sites), tables.gates, hot_rows=38)
    assert "events.parquet" not in plan.chain._jdf.queryExecution().executedPlan().toString()


def test_near_stops_are_searched_for_the_routes_in_use(spark):
    """Routes boarded, and as targets also rail lines and the bus routes that share a rail line's number."""
    tables = EventTables(spark, DATA)
    shared = tables.bus_sites.filter("route = '00000007'").withColumn("route", F.lit("00000091"))
    network = Network(tables.bus_sites.unionByName(shared), tables.rail_sites)
    routes = spark.createDataFrame([("00000002",), ("00000002",), ("00000005",), (None,)], "route string")

    def entries(df):
        return rows_of(df.select("target_route", "route", "direction", F.explode("stops").alias("s")).select("*", "s.*").drop("s"))

    rail = [r.route for r in tables.rail_sites.select("route").distinct().collect()]
    whole = nearby_stops(network.near).filter(F.col("route").isin("00000002", "00000005"))
    expected = entries(whole.filter(F.col("target_route").isin("00000002", "00000005", *rail)))
    assert any(r[0] == "00000091" for r in expected)
    assert entries(network.nearby(routes)) == expected
    saved = Network(network.bus_dictionary, tables.rail_sites, saved_near=network.near)
    assert entries(saved.nearby(routes)) == expected
