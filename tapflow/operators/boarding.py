"""Boarding stop of a bus tap: where the vehicle was last seen before the tap."""

from pyspark.sql import DataFrame, functions as F

from tapflow.schemas import BOARDED, VEHICLE_DAY

# Width of the time slots in which taps meet fixes, and how many make up a service day. Anything
# earlier or later falls in the first or last slot, which only makes that slot larger.
SLOT_MS = 600_000
SLOTS = 144


_SLOT = (
    f"cast(greatest(0, least({SLOTS - 1}, floor("
    f"(ts_ms - unix_millis(cast(service_date AS timestamp))) / {SLOT_MS}))) AS int) AS slot"
)


def fix_slots(runs: DataFrame) -> DataFrame:
    """(vehicle-day, slot) -> the fixes a tap in that slot may look back on, in time order.

    These are the fixes inside the slot and the last one before it. Slots without a fix repeat the
    last one, up to the end of the day, so every tap after the first fix finds exactly one row.
    """
    per_slot = runs.selectExpr("*", _SLOT).groupBy(*VEHICLE_DAY, "slot").agg(
        F.expr("sort_array(collect_list(struct(ts_ms, site, run))) AS fixes")
    )
    along = "OVER (PARTITION BY service_date, vehicle ORDER BY slot)"
    spans = per_slot.selectExpr(
        "*",
        f"lag(fixes) {along} AS before",
        f"coalesce(lead(slot) {along} - 1, {SLOTS - 1}) AS reach",
    )
    return spans.selectExpr(
        *VEHICLE_DAY, "slot AS home", "fixes", "before", "explode(sequence(slot, reach)) AS slot"
    ).selectExpr(
        *VEHICLE_DAY,
        "slot",
        """CASE WHEN slot > home THEN slice(fixes, -1, 1)
                WHEN before IS NULL THEN fixes
                ELSE concat(slice(before, -1, 1), fixes) END AS fixes""",
    )


def board_asof(taps: DataFrame, runs: DataFrame) -> DataFrame:
    """Latest fix of the tapped vehicle strictly before the tap; taps without one are dropped.

    The tap's own stop is replaced by the fix's, and the number of the run is added. Both sides
    meet on (day, vehicle, slot) and each tap meets one row, so a vehicle with very many taps is
    spread over its slots, and adaptive execution may split a slot further. Of several taps of one
    card in the same instant the one closest to its fix is kept.
    """
    key = ["service_date", "card", "ts_ms"]
    kept = [c for c in taps.columns if c not in {*key, "site"}]
    matched = (
        taps.selectExpr("*", _SLOT)
        .join(fix_slots(runs), [*VEHICLE_DAY, "slot"])
        .selectExpr(*key, *kept, "array_max(filter(fixes, f -> f.ts_ms < ts_ms)) AS fix")
    )
    # Taps without a fix go last; dropping them here, not before, looks up each tap's fix only once.
    closest = F.expr(f"max(struct(fix, {', '.join(kept)})) AS tap")
    return matched.groupBy(*key).agg(closest).filter("tap.fix IS NOT NULL").selectExpr(
        *key, *[f"tap.{c}" for c in kept],
        "tap.fix.ts_ms AS fix_ms", "tap.fix.site AS site", "tap.fix.run AS run",
    )


def site_lookup(asof: DataFrame, bus_sites: DataFrame) -> DataFrame:
    """Adds the dictionary's stop to a boarded tap; unknown stops stay with NULLs."""
    return asof.join(bus_sites, ["route", "site"], "left").select(*BOARDED)


def matched_boardings(boarded: DataFrame) -> DataFrame:
    return boarded.filter("site_id IS NOT NULL")


def vehicle_day(taps: DataFrame, vehicle: str) -> DataFrame:
    """All taps of one vehicle."""
    return taps.filter(F.col("vehicle") == vehicle)
