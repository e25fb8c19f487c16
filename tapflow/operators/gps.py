"""Vehicle traces: one fix per stop visit, then one-way runs."""

from pyspark.sql import DataFrame, functions as F

from tapflow.schemas import VEHICLE_DAY

# A longer silence than this at the same stop starts a new visit.
DWELL_MS = 600_000


def dwell_first(gps: DataFrame) -> DataFrame:
    """First fix of every stop visit of a vehicle.

    A visit ends when the same vehicle is not seen at the same stop for more than `DWELL_MS`. Two
    fixes inside one `DWELL_MS`-wide time bin can never be that far apart, so each bin is first
    reduced to its earliest and latest fix (combined map-side, whatever the vehicle's share of all
    fixes), and only bins are compared: at most 144 per vehicle, stop and day.
    """
    stop = [*VEHICLE_DAY, "site"]
    bins = gps.groupBy(*stop, F.expr(f"ts_ms div {DWELL_MS} AS bin")).agg(
        F.min("ts_ms").alias("ts_ms"), F.max("ts_ms").alias("last_ms")
    )
    # Placed by vehicle, so that the visits, the runs and all that follows share one exchange.
    bins = bins.repartition(*VEHICLE_DAY)
    gap = f"ts_ms - lag(last_ms) OVER (PARTITION BY {', '.join(stop)} ORDER BY bin) AS gap"
    return (
        bins.selectExpr("*", gap)
        .filter(f"gap IS NULL OR gap > {DWELL_MS}")
        .select(*VEHICLE_DAY, "ts_ms", "site")
    )


def trip_runs(fixes: DataFrame) -> DataFrame:
    """Numbers the one-way runs of a vehicle's day from 0.

    A run goes on while stop ordinals rise. A single out-of-order fix does not end it if the stop
    before and the stop after are consecutive, except on the last two fixes of the day.
    """
    vehicle_day = "PARTITION BY service_date, vehicle"
    along = f"OVER ({vehicle_day} ORDER BY ts_ms, site)"
    steps = fixes.selectExpr(
        "*",
        f"lag(site) {along} AS before",
        f"lead(site) {along} AS after",
        f"row_number() {along} <= count(*) OVER ({vehicle_day}) - 2 AS inner",
    )
    starts = """CASE WHEN before IS NULL OR before < site THEN 0
                     WHEN inner AND try_cast(before AS int) + 1 = try_cast(after AS int) THEN 0
                     ELSE 1 END"""
    so_far = f"OVER ({vehicle_day} ORDER BY ts_ms, site ROWS UNBOUNDED PRECEDING)"
    return steps.selectExpr(
        *VEHICLE_DAY, "ts_ms", "site", f"cast(sum({starts}) {so_far} AS int) AS run"
    )


def run_fixes(runs: DataFrame) -> DataFrame:
    """One row per run with its fixes in time order (a run holds one fix per stop visit)."""
    fixes = F.expr("sort_array(collect_list(struct(ts_ms, site))) AS fixes")
    return runs.groupBy(*VEHICLE_DAY, "run").agg(fixes)
