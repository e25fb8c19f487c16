"""A person's day as a chain: where each boarding leads to."""

from pyspark.sql import DataFrame

from tapflow.functions.keys import RAIL
from tapflow.operators.ordered import neighbours
from tapflow.schemas import BOARDED, BOARDING_ORDER, PERSON_DAY

# Stands for "after everything else" where a day's last boarding has no successor.
END_OF_TIME_MS = 5_000_000_000_000


def with_rail_boardings(boarded: DataFrame, legs: DataFrame) -> DataFrame:
    """Bus boardings and the entries of rail legs in one table."""
    rail = legs.selectExpr(
        "service_date", "card", "person", "card_type", "on_ms AS ts_ms", "vehicle",
        "on_route_id AS route_id", "on_route AS route", "on_site_id AS site_id", "on_site AS site",
        "on_site_name AS site_name", "direction", "on_lon AS lon", "on_lat AS lat", "change_type",
        "fare_due", "fare_paid", "cast(NULL AS int) AS run",
    )
    return boarded.select(*BOARDED).unionByName(rail)


def travel_chain(boardings: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Target route, stop and time of every bus boarding: the person's next boarding that day.

    The last boarding leads back to the first one, at `END_OF_TIME_MS`. Rail boardings are targets
    only and are dropped afterwards. `shared_tap` marks rows of one person in the same instant.
    """
    look = ["ts_ms", "route", "site"]
    rows = neighbours(
        boardings, PERSON_DAY, BOARDING_ORDER,
        previous=look, following=look, opening=look, hot=hot,
    )
    return rows.filter(f"NOT (direction <=> '{RAIL}')").selectExpr(
        *BOARDED,
        "coalesce(following, opening).route AS target_route",
        "coalesce(following, opening).site AS target_site",
        f"coalesce(following.ts_ms, {END_OF_TIME_MS}L) AS next_ms",
        "(previous.ts_ms <=> ts_ms) OR (following.ts_ms <=> ts_ms) AS shared_tap",
    )
