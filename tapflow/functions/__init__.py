"""Scalar functions as SQL text over Spark built-ins, so that they stay inside code generation."""

from tapflow.functions import keys
from tapflow.functions.binding import let
from tapflow.functions.fares import amount, amount_sum, free_ride
from tapflow.functions.geo import site_distance
from tapflow.functions.keys import (
    bus_direction, no_card, pad_route, pad_site, pad_type, pad_vehicle, person_key, rail_card,
    reserved_field, station_route, station_route_id, station_site, station_site_id,
)
from tapflow.functions.times import (
    compact_from_ms, month_from_ms, ms_from_compact, ms_from_text, service_day,
)

__all__ = [
    "amount", "amount_sum", "bus_direction", "compact_from_ms", "free_ride", "keys", "let", "month_from_ms",
    "ms_from_compact", "ms_from_text", "no_card", "pad_route", "pad_site", "pad_type", "pad_vehicle",
    "person_key", "rail_card", "reserved_field", "service_day", "site_distance", "station_route",
    "station_route_id", "station_site", "station_site_id",
]
