"""Legs of a day: bus rides with their alighting stop, together with rail rides."""

from pyspark.sql import DataFrame, functions as F

from tapflow.schemas import LEGS


def enrich(rides: DataFrame, bus_sites: DataFrame, how: str = "inner") -> DataFrame:
    """Adds the dictionary's alighting stop. `inner` drops rides to unknown stops, `left` keeps them."""
    stops = bus_sites.selectExpr(
        "route", "site AS off_site", "route_id AS off_route_id", "site_id AS off_site_id",
        "site_name AS off_site_name", "lon AS off_lon", "lat AS off_lat",
    )
    return rides.join(stops, ["route", "off_site"], how).selectExpr(
        "service_date", "person", "card", "ts_ms AS on_ms", "vehicle", "route_id AS on_route_id",
        "route AS on_route", "site_id AS on_site_id", "site AS on_site",
        "site_name AS on_site_name", "direction", "lon AS on_lon", "lat AS on_lat", "off_ms",
        "off_route_id", "route AS off_route", "off_site_id", "off_site", "off_site_name",
        "off_lon", "off_lat", "change_type", "fare_due", "fare_paid",
    )


def off_before_on(legs: DataFrame) -> DataFrame:
    """Marks legs whose inferred alighting lies before their boarding."""
    return legs.withColumn("off_before_on", F.col("off_ms") < F.col("on_ms"))


def all_legs(bus_legs: DataFrame, rail_legs: DataFrame | None = None) -> DataFrame:
    bus = bus_legs.select(*LEGS)
    return bus if rail_legs is None else bus.unionByName(rail_legs.select(*LEGS))
