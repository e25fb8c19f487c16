"""Transfers between consecutive legs of a person's day."""

from pyspark.sql import DataFrame

from tapflow.functions.keys import DOWN, UP
from tapflow.operators.ordered import neighbours
from tapflow.schemas import LEG_ORDER, LEGS, PERSON_DAY

TRANSFER_MS = 3_600_000

# Transfer codes written to the results.
NO_TRANSFER, BUS_TO_RAIL, RAIL_TO_BUS, BUS_TO_BUS, RAIL_TO_RAIL = "0", "1", "2", "3", "4"

PAIR = [
    "on_ms", "off_ms", "vehicle", "on_route_id", "off_route_id", "on_site_id", "off_site_id",
    "direction", "on_site_name", "off_site_name",
]


_BUS = "coalesce({} IN (" + f"'{UP}', '{DOWN}'" + "), false)"
_FROM_BUS, _TO_BUS = _BUS.format("previous.direction"), _BUS.format("direction")
# Boarded at most an hour after the previous boarding, at another stop.
_TRANSFER = f"""(previous IS NOT NULL AND on_ms - previous.on_ms <= {TRANSFER_MS}
                 AND NOT (previous.on_site_id <=> on_site_id))"""


def transfer_labels(legs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """All legs with the kind of transfer that led to them in `change_type`."""
    look = ["on_ms", "on_site_id", "direction"]
    rows = neighbours(legs, PERSON_DAY, LEG_ORDER, previous=look, hot=hot)
    code = f"""CASE WHEN NOT {_TRANSFER} THEN '{NO_TRANSFER}'
                    WHEN {_FROM_BUS} AND {_TO_BUS} THEN '{BUS_TO_BUS}'
                    WHEN {_FROM_BUS} THEN '{BUS_TO_RAIL}'
                    WHEN {_TO_BUS} THEN '{RAIL_TO_BUS}'
                    ELSE '{RAIL_TO_RAIL}' END AS change_type"""
    return rows.selectExpr(*[code if c == "change_type" else c for c in LEGS])


def transfer_pairs(legs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Previous and current leg of every transfer whose rider had got off before boarding again.

    The card is that of the previous leg, but of the current one from bus to rail.
    """
    rows = neighbours(legs, PERSON_DAY, LEG_ORDER, previous=["card", *PAIR], hot=hot)
    return rows.filter(f"{_TRANSFER} AND on_ms > previous.off_ms").selectExpr(
        *PERSON_DAY,
        f"IF({_FROM_BUS} AND NOT {_TO_BUS}, card, previous.card) AS card",
        *[f"previous.{c} AS pre_{c}" for c in PAIR],
        *[f"{c} AS curr_{c}" for c in PAIR],
    )
