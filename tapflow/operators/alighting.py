"""Where a bus rider got off: inferred from the next boarding, or drawn from history."""

from pyspark.sql import DataFrame, functions as F

from tapflow.functions import let
from tapflow.schemas import CHAINED, PERSON_DAY, VEHICLE_DAY

TAP = [*PERSON_DAY, "ts_ms"]

# What a leg shows when no alighting stop can be told.
UNKNOWN_SITE = "000000"
UNKNOWN_MS = 2_222_222_222_222

# Columns of a tap that later steps still need once its candidates are settled.
CARRIED = [c for c in CHAINED if c not in {"run", "target_route", "target_site", "next_ms"}]
RIDE = [c for c in CARRIED if c != "shared_tap"]


def candidates(chain: DataFrame, near: DataFrame) -> DataFrame:
    """Stops further down the boarded route, same direction, near a stop the target route has up to
    the target; one row per candidate, and one row with NULLs for a boarding without any."""
    n = near.selectExpr(
        "route AS near_route", "site AS near_site", "direction2 AS near_direction", "route_id2",
        "route2", "site_id2", "site2", "site_name2", "lon2", "lat2", "distance",
    )
    matches = F.expr(
        """target_route = near_route AND route = route2 AND direction = near_direction
           AND target_site >= near_site AND site < site2"""
    )
    return chain.join(n, matches, "left").selectExpr(
        *chain.columns, "near_site", "route_id2", "route2", "site_id2", "site2", "site_name2",
        "lon2", "lat2", "coalesce(distance, 0D) AS distance",
    )


def nearby_stops(near: DataFrame) -> DataFrame:
    """The near-stop table per (target route, boarded route, direction): at most as many entries as
    the two routes have pairs of stops. Attributes are in the order in which candidates compete."""
    stops = "collect_list(struct(distance, site2, near_site, site_id2)) AS stops"
    return (
        near.filter("site_id2 IS NOT NULL")
        .selectExpr(
            "route AS target_route", "route2 AS route", "direction2 AS direction", "distance",
            "site2", "site AS near_site", "site_id2",
        )
        .groupBy("target_route", "route", "direction")
        .agg(F.expr(stops))
    )


def infer(chain: DataFrame, run_fixes: DataFrame, nearby: DataFrame) -> DataFrame:
    """Nearest usable candidate of every boarding and the fix at which its rider got off.

    A candidate is usable if its stop ID is not before the boarding's and the boarded run had, before
    the next boarding, a fix at its stop or an earlier one; the latest such fix is the alighting.
    Candidates stay in an array beside the boarding instead of becoming rows to be grouped again.
    Adds `best` and `off` (both NULL if nothing is usable; then `visited` keeps the run's fixes
    before the next boarding).
    """
    rows = chain.join(run_fixes, [*VEHICLE_DAY, "run"], "left").join(
        nearby, ["target_route", "route", "direction"], "left"
    )
    visited = rows.selectExpr(
        *CARRIED, "target_site", "stops", "filter(fixes, f -> f.ts_ms < next_ms) AS visited"
    )
    usable = """s.near_site <= target_site AND s.site2 > site AND s.site_id2 >= site_id
                AND s.site2 >= lowest"""
    best = let("lowest", "array_min(visited.site)", f"array_min(filter(stops, s -> {usable}))")
    off = let("reach", "best.site2", "array_max(filter(visited, f -> f.site <= reach))")
    return (
        visited.selectExpr(*CARRIED, "visited", f"{best} AS best")
        .selectExpr("*", f"{off} AS off")
        .selectExpr(*CARRIED, "best", "off", "IF(off IS NULL, visited, NULL) AS visited")
    )


def one_leg_per_tap(inferred: DataFrame) -> DataFrame:
    """Keeps one row per (day, person, instant): the nearest alighting, else the first row.

    Only rows marked `shared_tap` can have company, so only those are grouped.
    """
    rank = """struct(off IS NULL, best, card, route, site, direction, vehicle, site_id, fare_due,
                     fare_paid)"""
    columns = [c for c in inferred.columns if c not in TAP]
    chosen = (
        inferred.filter("shared_tap")
        .groupBy(*TAP)
        .agg(F.expr(f"min(struct({rank} AS rank, {', '.join(columns)})) AS kept"))
        .selectExpr(*TAP, *[f"kept.{c}" for c in columns])
    )
    return inferred.filter("NOT shared_tap").unionByName(chosen)


def resolved_legs(taps: DataFrame) -> DataFrame:
    """Boardings whose alighting was inferred."""
    return taps.filter("off IS NOT NULL").selectExpr(
        *RIDE, "off.site AS off_site", "off.ts_ms AS off_ms", "best.distance AS distance",
        "cast(NULL AS bigint) AS weight",
    )


def alight_weights(resolved: DataFrame) -> DataFrame:
    """How often riders of a route got off at a stop, per day."""
    return resolved.groupBy("service_date", "route", F.col("off_site").alias("site")).agg(
        F.count(F.lit(1)).alias("weight")
    )


def merge_history(today: DataFrame, earlier: DataFrame) -> DataFrame:
    """Adds up two weight tables over the columns they key on."""
    keys = [c for c in today.columns if c != "weight"]
    return today.unionByName(earlier).groupBy(*keys).agg(F.sum("weight").alias("weight"))


def on_days(earlier: DataFrame, days: list) -> DataFrame:
    """Weights saved without a day, repeated for each service day of a run."""
    dates = F.array(*[F.lit(str(day)).cast("date") for day in days])
    return earlier.select(F.explode(dates).alias("service_date"), "route", "site", "weight")


def without_days(weights: DataFrame) -> DataFrame:
    """Weights summed over days, as they are saved."""
    return weights.groupBy("route", "site").agg(F.sum("weight").alias("weight"))


def history_by_route(weights: DataFrame) -> DataFrame:
    """Weights per (day, route) as an array in stop order: at most one entry per stop of the route."""
    history = F.expr("sort_array(collect_list(struct(site, weight))) AS history")
    return weights.groupBy("service_date", "route").agg(history)


# A repeatable number in [0, 1) for a tap: the first 32 bits of an MD5, over 2^32.
DRAW = "cast(conv(substr(md5(concat(person, ts_ms)), 1, 8), 16, 10) AS double) / 4294967296D"

# Entries of `history` further down the route that the run visited.
REACHABLE = let(
    "seen", "visited.site",
    "filter(history, h -> h.site > site AND array_contains(seen, h.site))",
)

# First reachable entry whose running share of the total weight exceeds the draw.
PICK = let("entries", "reachable", let(
    "v", f"struct(aggregate(entries.weight, 0L, (sum, w) -> sum + w) AS total, {DRAW} AS draw)",
    """aggregate(
        entries,
        struct(0L AS passed, cast(NULL AS struct<site: string, weight: bigint>) AS pick),
        (acc, h) -> struct(
            acc.passed + h.weight AS passed,
            coalesce(
                acc.pick,
                IF(cast(acc.passed + h.weight AS double) / cast(v.total AS double) > v.draw, h, NULL)
            ) AS pick
        )
    ).pick""",
))
AT_PICK = let("there", "pick.site", "array_max(filter(visited, f -> f.site = there))")


def fallback_legs(
    taps: DataFrame, history: DataFrame, keep_unmatched: bool = False
) -> DataFrame:
    """Alighting of the boardings that `infer` could not settle.

    Among stops further down the route that are in the history and that the run visited before the
    next boarding, one is drawn in proportion to its weight. If there is none, it is the latest
    fix beyond the boarding stop, else `UNKNOWN_SITE` at `UNKNOWN_MS`. A boarding without any
    downstream history on its route gives no leg, unless `keep_unmatched`.
    """
    rows = (
        taps.filter("off IS NULL")
        .join(history, ["service_date", "route"], "left" if keep_unmatched else "inner")
    )
    if not keep_unmatched:
        rows = rows.filter("exists(history, h -> h.site > site)")
    return (
        rows.selectExpr(*RIDE, "visited", f"{REACHABLE} AS reachable")
        .selectExpr(*RIDE, "visited", f"{PICK} AS pick")
        .selectExpr(
            *RIDE,
            "pick",
            f"""coalesce(
                {AT_PICK},
                array_max(filter(visited, f -> f.site > site)),
                struct({UNKNOWN_MS}L AS ts_ms, '{UNKNOWN_SITE}' AS site)
            ) AS off""",
        )
        .selectExpr(
            *RIDE, "off.site AS off_site", "off.ts_ms AS off_ms",
            "cast(NULL AS double) AS distance", "pick.weight AS weight",
        )
    )
