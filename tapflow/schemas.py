"""Column names of the raw feeds (fixed by their files) and of the engine's tables.

Raw feeds carry no usable header names: columns are text, named by position.
Fixed values, kept together so that readers and tests share one list.
"""

TAPS_RAW = [
    "tap_time", "x1", "card", "card_type", "fare_due", "fare_paid", "change_type",
    "x5", "x6", "vehicle", "route", "site",
]

GATES_RAW = [
    "card", "date", "time", "x4", "x5", "x6", "x7", "card_type", "x9", "x10", "x11", "in_out",
    "station", "last_station", "x15", "x16", "txn_amt", "x18", "reward_amt", "x20", "x21", "x22",
    "x23", "x24", "x25", "x26", "x27", "x28", "x29", "x30", "x31", "x32", "x33", "x34", "rsv_buf",
    "x36", "x37", "x38", "x39",
]
GATES_KEPT = [
    "card", "card_type", "date", "time", "station", "last_station", "in_out", "rsv_buf",
    "txn_amt", "reward_amt",
]

GPS_RAW = ["card", "vehicle", "gps_time", "x4", "x5", "x6", "site"]

BUS_SITES_RAW = [
    "route_id", "route", "route_name", "site_id", "site_code", "site_name", "up_down", "site",
    "type", "lon", "lat", "distance",
]

VEHICLES_RAW = ["vehicle", "x2", "route", "route_id"]

# Cleaned tables -----------------------------------------------------------------------------

TAPS = [
    "service_date", "card", "person", "card_type", "ts_ms", "vehicle", "route", "site",
    "change_type", "fare_due", "fare_paid",
]
SITES = ["route_id", "route", "site_id", "site", "site_name", "direction", "lon", "lat"]

BOARDED = [
    "service_date", "card", "person", "card_type", "ts_ms", "vehicle", "route_id", "route",
    "site_id", "site", "site_name", "direction", "lon", "lat", "change_type", "fare_due",
    "fare_paid", "run",
]
CHAINED = BOARDED + ["target_route", "target_site", "next_ms", "shared_tap"]

# One ride: where and when the rider got on and off.
LEGS = [
    "service_date", "person", "card", "on_ms", "vehicle", "on_route_id", "on_route", "on_site_id",
    "on_site", "on_site_name", "direction", "on_lon", "on_lat", "off_ms", "off_route_id",
    "off_route", "off_site_id", "off_site", "off_site_name", "off_lon", "off_lat", "change_type",
    "fare_due", "fare_paid",
]

# Total order of a person's rows inside a day: time first, business columns break ties.
BOARDING_ORDER = [
    "ts_ms", "card", "route", "site", "direction", "vehicle", "site_id", "fare_due", "fare_paid",
]
LEG_ORDER = [
    "on_ms", "card", "on_route", "on_site", "direction", "vehicle", "on_site_id", "off_ms",
    "off_site_id", "fare_due", "fare_paid",
]
GATE_ORDER = [
    "ts_ms", "card", "in_out", "station", "card_type", "fare_due", "fare_paid", "site_name",
    "lon", "lat",
]

PERSON_DAY = ["service_date", "person"]
VEHICLE_DAY = ["service_date", "vehicle"]
