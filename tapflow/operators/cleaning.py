"""Raw text feeds to typed tables.

`service_date` names the day of a one-day file; `day` is SQL over the raw row that gives it, for many files at once
(for instance a column, or a part of `_metadata.file_path`); without both it is the day of the record. Records whose
time cannot be read, and taps and gate records without a card, are left out; `feed_rejects` counts them.
"""

from functools import reduce

from pyspark.sql import DataFrame

from tapflow import functions as fn
from tapflow.schemas import TAPS


def _dated(raw: DataFrame, columns: list[str], service_date: str | None, day: str | None) -> DataFrame:
    """`columns` of the raw rows that have a time, with the service day first."""
    given = day or (f"DATE '{service_date}'" if service_date else "CAST(NULL AS date)")
    rows = raw.selectExpr(f"CAST({given} AS date) AS file_day", *columns).filter("ts_ms IS NOT NULL")
    return rows.selectExpr(f"coalesce(file_day, {fn.service_day('ts_ms')}) AS service_date", "* EXCEPT (file_day)")


def clean_taps(raw: DataFrame, service_date: str | None = None, day: str | None = None) -> DataFrame:
    """Bus taps with padded keys; free card types owe and pay nothing."""
    return _dated(raw.filter(f"NOT ({fn.no_card('card')})"), [
        "card",
        f"{fn.person_key('card')} AS person",
        f"{fn.pad_type('card_type')} AS card_type",
        f"{fn.ms_from_text('tap_time')} AS ts_ms",
        f"{fn.pad_vehicle('vehicle')} AS vehicle",
        f"{fn.pad_route('route')} AS route",
        f"{fn.pad_site('site')} AS site",
        "change_type",
        f"{fn.free_ride('card_type', fn.amount('fare_due'))} AS fare_due",
        f"{fn.free_ride('card_type', fn.amount('fare_paid'))} AS fare_paid",
    ], service_date, day).select(*TAPS)


def clean_gates(raw: DataFrame, service_date: str | None = None, day: str | None = None) -> DataFrame:
    """Rail gate records; the amount due is the amount paid plus the reward."""
    return _dated(raw.filter(f"NOT ({fn.no_card('card')})"), [
        f"{fn.rail_card('card')} AS card",
        f"{fn.person_key(fn.rail_card('card'))} AS person",
        f"{fn.pad_type('card_type')} AS card_type",
        f"{fn.ms_from_compact('concat(date, time)')} AS ts_ms",
        "station",
        "in_out",
        f"{fn.amount_sum('txn_amt', 'reward_amt')} AS fare_due",
        f"{fn.amount('txn_amt')} AS fare_paid",
    ], service_date, day)


def clean_gps(raw: DataFrame, service_date: str | None = None, day: str | None = None) -> DataFrame:
    """GPS fixes taken at a stop (`0`, as written, means between stops)."""
    return _dated(raw.filter("site != '0'"), [
        f"{fn.pad_vehicle('vehicle')} AS vehicle",
        f"{fn.ms_from_text('gps_time')} AS ts_ms",
        f"{fn.pad_site('site')} AS site",
    ], service_date, day)


def clean_bus_sites(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "route_id",
        f"{fn.pad_route('route')} AS route",
        "site_id",
        f"{fn.pad_site('site')} AS site",
        "site_name",
        f"{fn.bus_direction('up_down')} AS direction",
        "try_cast(lon AS double) AS lon",
        "try_cast(lat AS double) AS lat",
    )


def clean_rail_sites(raw: DataFrame) -> DataFrame:
    """Rail stations from the four-digit code: line (2) and stop (2)."""
    return raw.selectExpr(
        f"{fn.station_route_id('_c1')} AS route_id",
        f"{fn.station_route('_c1')} AS route",
        f"{fn.station_site_id('_c1')} AS site_id",
        f"{fn.station_site('_c1')} AS site",
        "_c3 AS site_name",
        f"'{fn.keys.RAIL}' AS direction",
        "try_cast(_c5 AS double) AS lon",
        "try_cast(_c6 AS double) AS lat",
    )


def clean_vehicles(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        f"{fn.pad_vehicle('vehicle')} AS vehicle", f"{fn.pad_route('route')} AS route"
    )


def tap_rejects(raw: DataFrame) -> DataFrame:
    """How many raw tap rows have a time or a fare that cannot be read."""
    return raw.selectExpr(
        f"count_if({fn.ms_from_text('tap_time')} IS NULL) AS bad_time",
        f"count_if({fn.amount('fare_due')} IS NULL) AS bad_fare_due",
        f"count_if({fn.amount('fare_paid')} IS NULL) AS bad_fare_paid",
        "count(*) AS rows",
    )


def gate_rejects(raw: DataFrame) -> DataFrame:
    """How many raw gate rows have a time or an amount that cannot be read."""
    return raw.selectExpr(
        f"count_if({fn.ms_from_compact('concat(date, time)')} IS NULL) AS bad_time",
        f"count_if({fn.amount_sum('txn_amt', 'reward_amt')} IS NULL) AS bad_amount",
        "count(*) AS rows",
    )


def _wider(column: str, width: int) -> str:
    return f"count_if(length({column}) > {width}) AS wide_{column}"


def feed_rejects(taps: DataFrame, gps: DataFrame, gates: DataFrame | None = None) -> DataFrame:
    """One row per raw feed: rows, rejected lines, and how many others have an unreadable time, no card, or keys wider than usual.

    A feed read by `feeds.read_lines` has `line`, the text of a line with the wrong number of fields; those are rejected.
    Rows with an unreadable time or without a card are left out by cleaning; wide keys are kept whole.
    """
    wide = [_wider("vehicle", fn.keys.VEHICLE), _wider("route", fn.keys.ROUTE), _wider("site", fn.keys.SITE)]
    none = ["CAST(0 AS bigint) AS wide_vehicle", "CAST(0 AS bigint) AS wide_route", "CAST(0 AS bigint) AS wide_site"]

    def counted(feed: str, raw: DataFrame, time: str, card: str, keys: list[str]) -> DataFrame:
        read = "line IS NULL" if "line" in raw.columns else "true"
        return raw.selectExpr(
            f"'{feed}' AS feed", "count(*) AS rows", f"count_if(NOT ({read})) AS rejected",
            f"count_if({read} AND {time} IS NULL) AS bad_time", f"count_if({read} AND {card}) AS bad_card",
            *[k.replace("count_if(", f"count_if({read} AND ") for k in keys],
        )

    parts = [
        counted("taps", taps, fn.ms_from_text("tap_time"), fn.no_card("card"), wide),
        counted("gps", gps, fn.ms_from_text("gps_time"), "false", [wide[0], none[1], wide[2]]),
    ]
    if gates is not None:
        parts.append(counted("gates", gates, fn.ms_from_compact("concat(date, time)"), fn.no_card("card"), none))
    return reduce(DataFrame.unionByName, parts)
