"""Runs that write their results: a day or many days, and the near-stop table."""

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tapflow import functions as fn

from tapflow.operators.alighting import on_days, without_days
from tapflow.operators.journeys import HEAD_AND_LAST, journeys
from tapflow.operators.legs import all_legs
from tapflow.operators.sites import all_sites, near_sites
from tapflow.operators.transfers import transfer_pairs
from tapflow.plans.day import OdPlan
from tapflow.plans.network import Network
from tapflow.operators import cleaning
from tapflow.operators.sizing import cut_lineage, scratch_scope
from tapflow.sources import feeds, tables


def near_sites_table(
    spark: SparkSession, path: str, bus_sites: DataFrame, rail_sites: DataFrame | None = None
) -> DataFrame:
    """The saved near-stop table, built on first use. It must be removed when stops change."""
    stops = bus_sites if rail_sites is None else all_sites(bus_sites, rail_sites)
    return tables.read_or_build(spark, path, lambda: near_sites(stops, bus_sites))


def service_days(feeds: list[DataFrame]) -> list[date]:
    """Calendar days found in the feeds: as many values as there are days, not records."""
    dated = reduce(DataFrame.unionByName, [f.select("service_date") for f in feeds])
    return sorted(row[0] for row in dated.distinct().collect())


def run(
    taps: DataFrame,
    gps_fixes: DataFrame,
    bus_sites: DataFrame,
    out: str,
    gates: DataFrame | None = None,
    rail_sites: DataFrame | None = None,
    near_path: str | None = None,
    history_path: str | None = None,
    save_history: bool = True,
    keep_unmatched: bool = False,
    fare: str = HEAD_AND_LAST,
    fmt: str = "parquet",
    days: list[date] | None = None,
    intermediates: bool = False,
    publish: bool = False,
    history_log: bool = False,
) -> None:
    """Writes `out`/legs, `out`/transfers and `out`/journeys for all service days in the feeds.

    Without `gates` it is a bus-only run. The legs are written first, with their times as numbers
    (`out`/legs_ms), and the results are derived from that table: the long part of the lineage runs
    once and a lost executor costs no more than the step in hand. `days` are the feeds' service days;
    left out, they are looked up. `intermediates` also writes the vehicles' runs, the boarded taps and
    all rides with their alighting stop where it is known (`out`/runs, /boarded, /rides).

    With `publish`, every result of the run is staged and all become visible at once through a new manifest under
    `out` (`tables.Publication`); read them with `tables.read_published`. A run that fails on the way changes nothing
    that readers see. With `history_log`, the history at `history_path` is a log: the run adds its own days only
    (`tables.write_history_log`) instead of a new full copy.
    """
    with scratch_scope(taps.sparkSession):  # tables cut from the lineage go when the results are written
        _run(taps, gps_fixes, bus_sites, out, gates, rail_sites, near_path, history_path, save_history, keep_unmatched, fare, fmt, days, intermediates, publish, history_log)


def _run(taps, gps_fixes, bus_sites, out, gates, rail_sites, near_path, history_path, save_history, keep_unmatched, fare,
         fmt, days, intermediates, publish, history_log) -> None:
    spark = taps.sparkSession
    if days is not None:  # all steps see the same days
        taps, gps_fixes = (x.filter(F.col("service_date").isin(days)) for x in (taps, gps_fixes))
        gates = None if gates is None else gates.filter(F.col("service_date").isin(days))
    taps, gates = cut_lineage(taps), None if gates is None else cut_lineage(gates)
    if days is None:
        days = service_days([taps] if gates is None else [taps, gates])
    near = near_sites_table(spark, near_path, bus_sites, rail_sites) if near_path else None
    if history_path and history_log:
        saved = tables.read_history_log(spark, history_path)
    else:
        saved = tables.read_history(spark, history_path) if history_path else None
    if saved is not None:  # what an earlier run of the same days saved is replaced
        saved = saved.filter(~F.col("service_date").isin(days))
    plan = OdPlan(
        taps=taps, gps_fixes=gps_fixes, gates=gates, feeds_stored=True, keep_unmatched=keep_unmatched, fare=fare,
        network=Network(bus_sites, rail_sites, near),
        earlier_history=None if saved is None else on_days(without_days(saved), days),
    )
    if history_path and save_history and history_log:
        tables.write_history_log(plan.weights, history_path, days)
        tables.compact_history_log(spark, history_path)
    elif history_path and save_history:
        tables.write_history(plan.weights if saved is None else saved.unionByName(plan.weights), history_path)
    publication = tables.Publication(spark, out, days) if publish else None

    def sink(df: DataFrame, name: str, kind: str = fmt) -> None:
        if publication is None:
            tables.write_days(df, f"{out}/{name}", kind, days)
        else:
            publication.stage(df, name, kind)

    if intermediates:
        sink(plan.trip_runs, "runs")
        sink(plan.boarded, "boarded")
        sink(all_legs(plan.bus_legs("left"), plan.rail_legs), "rides")
    if publication is None:
        tables.write_days(plan.labelled, f"{out}/legs_ms", days=days)
        legs = spark.read.schema(plan.labelled.schema).parquet(f"{out}/legs_ms").filter(F.col("service_date").isin(days))
    else:
        legs = publication.stage(plan.labelled, "legs_ms", "parquet")
    sink(tables.legs_output(legs), "legs")
    pairs = transfer_pairs(legs, plan.hot_persons)
    sink(tables.transfers_output(pairs), "transfers")
    merged = journeys(legs, fare, plan.hot_persons)
    sink(tables.journeys_output(merged), "journeys")
    if publication is not None:
        publication.commit()
        tables.retire(spark, out)


#: Per feed: its cleaning, and SQL over its raw text columns that tells an unreadable time and a missing card.
_CLEANING = {
    "taps": (cleaning.clean_taps, fn.ms_from_text("tap_time") + " IS NULL", fn.no_card("card")),
    "gps": (cleaning.clean_gps, fn.ms_from_text("gps_time") + " IS NULL", "false"),
    "gates": (cleaning.clean_gates, fn.ms_from_compact("concat(date, time)") + " IS NULL", fn.no_card("card")),
}


def observed_feed(spark: SparkSession, path: str, feed: str, fmt: str = "csv") -> tuple[DataFrame, Observation]:
    """Every line of a feed's files (`feeds.read_lines`) with counts that the first pass over it observes:
    rows, rejected (wrong number of fields), and among the others bad_time and bad_card."""
    _, time, card = _CLEANING[feed]
    seen = Observation(f"{feed}-{uuid.uuid4()}")
    read = "line IS NULL"
    lines = feeds.read_lines(spark, path, feed, fmt).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"count_if(NOT ({read}))").alias("rejected"),
        F.expr(f"count_if({read} AND {time})").alias("bad_time"),
        F.expr(f"count_if({read} AND {card})").alias("bad_card"),
    )
    return lines, seen


def run_files(
    spark: SparkSession, paths: dict[str, str], bus_sites: DataFrame, out: str, rail_sites: DataFrame | None = None,
    fmt: str = "csv", **options,
) -> dict[str, dict[str, int]]:
    """`run` over the feed files at `paths` (keys taps, gps and gates; without gates a bus-only run).

    Lines with the wrong number of fields go to `out`/rejects/<feed> (`file`, `line`); the pass that writes them counts,
    for each feed, its rows, rejected lines, unreadable times and missing cards, which are returned. Cleaning leaves out
    the last two as before.
    """
    counts, cleaned = {}, {}
    for feed, path in paths.items():
        lines, seen = observed_feed(spark, path, feed, fmt)
        lines.filter("line IS NOT NULL").select("file", "line").write.mode("overwrite").parquet(f"{out}/rejects/{feed}")
        counts[feed] = seen.get
        clean = _CLEANING[feed][0]
        cleaned[feed] = clean(lines.filter("line IS NULL").select(*feeds.FEEDS[feed][1]))
    run(cleaned["taps"], cleaned["gps"], bus_sites, out, cleaned.get("gates"), rail_sites, **options)
    return counts
