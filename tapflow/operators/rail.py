"""Rail gate records to complete rail legs."""

from pyspark.sql import DataFrame

from tapflow import functions as fn
from tapflow.functions.keys import NO_VEHICLE, RAIL
from tapflow.operators.ordered import neighbours
from tapflow.schemas import GATE_ORDER, PERSON_DAY

GATE_IN, GATE_OUT = "21", "22"


def station_join(gates: DataFrame, rail_sites: DataFrame) -> DataFrame:
    """Adds name and position of the station; records of unknown stations are dropped."""
    stations = rail_sites.selectExpr("substr(site_id, 13, 4) AS station", "site_name", "lon", "lat")
    return gates.join(stations, "station")


def rail_legs(located: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """An entry directly followed by an exit of the same person is a leg.

    The card is the larger of the two numbers, the card type is the entry's and the fares are the
    exit's. Exact copies of a record lie next to each other in the order and never add a leg, so
    they may be collapsed before a hot key is cut.
    """
    taken = ["card", "ts_ms", "in_out", "station", "site_name", "lon", "lat", "fare_due", "fare_paid"]
    rows = neighbours(
        located, PERSON_DAY, GATE_ORDER, following=taken, hot=hot, collapse_copies=True
    )
    out = "following.station"
    return rows.filter(f"in_out = '{GATE_IN}' AND following.in_out = '{GATE_OUT}'").selectExpr(
        "service_date",
        "person",
        "greatest(card, following.card) AS card",
        "ts_ms AS on_ms",
        f"'{NO_VEHICLE}' AS vehicle",
        f"{fn.station_route_id('station')} AS on_route_id",
        f"{fn.station_route('station')} AS on_route",
        f"{fn.station_site_id('station')} AS on_site_id",
        f"{fn.station_site('station')} AS on_site",
        "site_name AS on_site_name",
        f"'{RAIL}' AS direction",
        "lon AS on_lon",
        "lat AS on_lat",
        "following.ts_ms AS off_ms",
        f"{fn.station_route_id(out)} AS off_route_id",
        f"{fn.station_route(out)} AS off_route",
        f"{fn.station_site_id(out)} AS off_site_id",
        f"{fn.station_site(out)} AS off_site",
        "following.site_name AS off_site_name",
        "following.lon AS off_lon",
        "following.lat AS off_lat",
        "'' AS change_type",
        "following.fare_due AS fare_due",
        "following.fare_paid AS fare_paid",
        "card_type",
    )
