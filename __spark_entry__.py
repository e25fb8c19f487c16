
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import oracle
from tapflow import functions as fn
from tapflow.operators import alighting, boarding, cleaning, gps, legs, rail
from tapflow.operators.sites import all_sites, near_sites
from tapflow.plans.day import OdPlan
from tapflow.plans.network import Network
from tapflow.operators.sizing import cut_lineage, scratch_path
from tapflow.plans import jobs
from tapflow.sources import feeds, tables
from tapflow.sources.event_tables import DAY_STARTS, EventTables, write_day_files, write_feed_files

llm = corpus_pipeline = None
try:  # the subpackage and its pipeline may be left out
    import tapflow.llm.queries as llm

    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("tapflow.llm", "tapflow.llm.queries", "corpus_pipeline"):
        raise

#: Records of a person and day from which the *_hot queries take the other way; some persons have more at every scale.
HOT = 36

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Column types both engines agree on: bigint, double, string."""
    kinds = {"date": "string", "int": "bigint"}
    return df.selectExpr(*[
        f"cast({name} AS {kinds[kind]}) AS {name}" if kind in kinds else name
        for name, kind in df.dtypes
    ])


def _plan(spark: SparkSession, folder: str, with_rail: bool = True, squeeze: int = 60, **options) -> OdPlan:
    """The plan of a query; each builds its own stop network."""
    tables = EventTables(spark, folder, squeeze)
    return OdPlan(
        taps=tables.taps,
        gps_fixes=tables.gps_fixes,
        network=Network(tables.bus_sites, tables.rail_sites if with_rail else None),
        gates=tables.gates if with_rail else None,
        **options,
    )


def _near_sites(tables: EventTables) -> DataFrame:
    return near_sites(all_sites(tables.bus_sites, tables.rail_sites), tables.bus_sites)


def _of_tables(step: Callable[[EventTables], DataFrame]) -> Query:
    return lambda spark, folder: _plain(step(EventTables(spark, folder)))


def _of_plan(step: Callable[[OdPlan], DataFrame], **options) -> Query:
    return lambda spark, folder: _plain(step(_plan(spark, folder, **options)))


def _feed_files(spark: SparkSession, folder: str, feed: str) -> str:
    """The adapter's rows of a feed written as its text files, some lines damaged; their folder."""
    tables = EventTables(spark, folder)
    path = scratch_path(spark, f"feed-{feed}")
    write_feed_files({"taps": tables.taps_raw, "gates": tables.gates_raw, "gps": tables.gps_raw}[feed], feed, path)
    return path


def _read_back(feed: str) -> Query:
    """Every line of a feed's files through its reader: the columns, and the text of a rejected line."""
    return lambda spark, folder: _plain(feeds.read_lines(spark, _feed_files(spark, folder, feed), feed).drop("file"))


def _feed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    lines = {f: feeds.read_lines(spark, _feed_files(spark, folder, f), f) for f in ("taps", "gps", "gates")}
    return cleaning.feed_rejects(lines["taps"], lines["gps"], lines["gates"])


def _write_read_results(spark: SparkSession, folder: str) -> DataFrame:
    """The bus and rail job with its results published together, and its legs read back through the manifest."""
    t = EventTables(spark, folder)
    out = scratch_path(spark, "results")
    jobs.run(t.taps, t.gps_fixes, t.bus_sites, out, gates=t.gates, rail_sites=t.rail_sites, publish=True)
    return _plain(tables.read_published(spark, out, "legs_ms"))


def _history_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into a history log: all days' weights, then the first day again one higher; read back, newest per day."""
    weights = _plan(spark, folder).weights
    out = scratch_path(spark, "history")
    tables.write_history_log(weights, out)
    first = weights.agg(F.min("service_date")).first()[0]
    again = weights.filter(F.col("service_date") == first).withColumn("weight", F.col("weight") + 1)
    tables.write_history_log(again, out, [first] if first else [])
    read = tables.read_history_log(spark, out)
    return _plain(read if read is not None else weights.limit(0))


def _od_month_files(spark: SparkSession, folder: str) -> DataFrame:
    """A month of journeys from feeds that come as one folder per day: each record's day is its file's, so rides after
    midnight stay in the day before; all days are read at once and the day comes from `_metadata.file_path`."""
    t = EventTables(spark, folder, squeeze=1)
    top = scratch_path(spark, "month")
    for feed, rows in (("taps", t.taps_raw), ("gps", t.gps_raw), ("gates", t.gates_raw)):
        write_day_files(rows, feed, f"{top}/{feed}")

    def read(feed: str) -> DataFrame:
        return feeds.read_day_folders(spark, f"{top}/{feed}", feed).filter("line IS NULL")

    day = feeds.day_of_file()
    plan = OdPlan(
        taps=cleaning.clean_taps(read("taps"), day=day), gps_fixes=cleaning.clean_gps(read("gps"), day=day),
        gates=cleaning.clean_gates(read("gates"), day=day), network=Network(t.bus_sites, t.rail_sites),
    )
    return _plain(plan.journeys)


def _time_format_roundtrip(t: EventTables) -> DataFrame:
    rows = t.gates_raw.selectExpr("card", "station", "concat(date, time) AS text")
    return rows.selectExpr("*", f"{fn.ms_from_compact('text')} AS ms").selectExpr(
        "*", f"{fn.compact_from_ms('ms')} AS back", f"{fn.month_from_ms('ms')} AS month",
        f"{fn.compact_from_ms('(-ms)')} AS before_1970",
    )


def _site_distance(t: EventTables) -> DataFrame:
    """Every bus stop to the next one of its route, and to a stop without a position."""
    along = "OVER (PARTITION BY route_id ORDER BY site)"
    rows = t.bus_sites.selectExpr(
        "route_id", "site", "lon", "lat",
        *[f"lead({c}) {along} AS next_{c}" for c in ("site", "lon", "lat")],
    )
    return rows.selectExpr(
        "route_id", "site", "next_site",
        f"{fn.site_distance('lon', 'lat', 'next_lon', 'next_lat')} AS to_next",
        f"{fn.site_distance('lon', 'lat', '0', 'lat')} AS to_nowhere",
    )


def _run_fixes(t: EventTables) -> DataFrame:
    fixes = gps.run_fixes(gps.trip_runs(gps.dwell_first(t.gps_fixes)))
    return fixes.selectExpr(
        "service_date", "vehicle", "run", "size(fixes) AS fixes_in_run",
        "fixes[0].ts_ms AS first_ms", "element_at(fixes, -1).ts_ms AS last_ms", "inline(fixes)",
    )


def _history_merge(plan: OdPlan) -> DataFrame:
    """The day's alighting weights on top of a history made of its boardings."""
    plan.boarded = cut_lineage(plan.boarded)  # the chain needs it as well
    earlier = plan.boarded.groupBy("service_date", "route", "site").agg(F.count("*").alias("weight"))
    return alighting.merge_history(plan.weights, earlier)


def entry(spark: SparkSession) -> DataFrame:
    """All legs of a day of bus and rail, with the kind of transfer."""
    return queries()["od_bus_rail_day"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query: the engine's own, and those of the training-data operators if they are there."""
    found = transit_queries()
    if llm:
        found |= llm.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = transit_sql()
    if llm:
        found |= llm.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def transit_queries() -> dict[str, Query]:
    return {
        "src_bus_taps": _of_tables(lambda t: t.taps_raw),
        "src_rail_gates": _of_tables(lambda t: t.gates_raw),
        "src_gps": _of_tables(lambda t: t.gps_raw),
        "src_bus_sites": _of_tables(lambda t: t.bus_sites_raw),
        "src_rail_sites": _of_tables(lambda t: t.rail_sites_raw),
        "src_vehicles": _of_tables(lambda t: cleaning.clean_vehicles(t.vehicles_raw)),
        "tap_clean": _of_tables(lambda t: t.taps),
        "rail_clean": _of_tables(lambda t: t.gates),
        "gps_clean": _of_tables(lambda t: t.gps_fixes),
        "site_distance": _of_tables(_site_distance),
        "time_format_roundtrip": _of_tables(_time_format_roundtrip),
        "vehicle_day": _of_tables(lambda t: boarding.vehicle_day(t.taps, "00000003")),
        "all_sites": _of_tables(lambda t: all_sites(t.bus_sites, t.rail_sites)),
        "near_sites": _of_tables(_near_sites),
        "gps_dwell_first": _of_tables(lambda t: gps.dwell_first(t.gps_fixes)),
        "gps_trip_runs": _of_tables(lambda t: gps.trip_runs(gps.dwell_first(t.gps_fixes))),
        "gps_run_fixes": _of_tables(_run_fixes),
        "board_asof": _of_tables(
            lambda t: boarding.board_asof(t.taps, gps.trip_runs(gps.dwell_first(t.gps_fixes)))
        ),
        "board_site_lookup": _of_plan(lambda p: p.boarded),
        "matched_boardings": _of_plan(lambda p: boarding.matched_boardings(p.boarded)),
        "rail_station_join": _of_plan(lambda p: rail.station_join(p.gates, p.network.rail_sites)),
        "rail_legs": _of_plan(lambda p: p.rail_legs),
        "travel_chain": _of_plan(lambda p: p.chain.drop("shared_tap")),
        "alight_candidates": _of_plan(
            lambda p: alighting.candidates(p.chain.drop("shared_tap"), p.network.near)
        ),
        "alight_inferred": _of_plan(lambda p: p.resolved),
        "alight_weights": _of_plan(lambda p: p.weights),
        "history_merge": _of_plan(_history_merge),
        "alight_fallback": _of_plan(lambda p: p.fallback),
        "od_legs": _of_plan(lambda p: p.legs),
        "od_enrich_inner": _of_plan(lambda p: p.bus_legs("inner")),
        "od_enrich_left": _of_plan(lambda p: p.bus_legs("left")),
        "transfer_labels": _of_plan(lambda p: p.labelled),
        "transfer_pairs": _of_plan(lambda p: p.transfers),
        "journeys": _of_plan(lambda p: p.journeys),
        "od_bus_day": _of_plan(lambda p: p.labelled, with_rail=False),
        "od_bus_rail_day": _of_plan(lambda p: legs.off_before_on(p.labelled)),
        "od_month": _of_plan(lambda p: p.journeys, squeeze=1),
        # the same steps with part of the persons taken as too large for one task
        "rail_legs_hot": _of_plan(lambda p: p.rail_legs, hot_rows=HOT),
        "travel_chain_hot": _of_plan(lambda p: p.chain.drop("shared_tap"), hot_rows=HOT),
        "transfer_labels_hot": _of_plan(lambda p: p.labelled, hot_rows=HOT),
        "transfer_pairs_hot": _of_plan(lambda p: p.transfers, hot_rows=HOT),
        "journeys_hot": _of_plan(lambda p: p.journeys, hot_rows=HOT),
        "feed_rejects": _feed_rejects,
        "read_bus_taps": _read_back("taps"),
        "read_rail_gates": _read_back("gates"),
        "read_gps": _read_back("gps"),
        "write_read_results": _write_read_results,
        "history_log": _history_log,
        "od_month_files": _od_month_files,
    }


def transit_sql() -> dict[str, str]:
    sql = oracle.sql
    chain = f"{oracle.BOARDED}, target_route, target_site, next_ms"
    return {
        "src_bus_taps": sql("SELECT * EXCLUDE (t) FROM taps_raw"),
        "src_rail_gates": sql("SELECT * EXCLUDE (t) FROM gates_raw"),
        "src_gps": sql("SELECT * EXCLUDE (t) FROM gps_raw"),
        "src_bus_sites": sql(
            """SELECT s.route_id, s.route::BIGINT::VARCHAR AS route, NULL::VARCHAR AS route_name,
                      s.site_id, NULL::VARCHAR AS site_code, s.site_name,
                      CASE s.direction WHEN '0' THEN '上行' ELSE '下行' END AS up_down,
                      s.site::BIGINT::VARCHAR AS site, NULL::VARCHAR AS type,
                      s.lon::VARCHAR AS lon, s.lat::VARCHAR AS lat, NULL::VARCHAR AS distance
               FROM bus_sites s"""
        ),
        "src_rail_sites": sql(
            """SELECT right(site_id, 4) AS _c1, site_name AS _c3, lon::VARCHAR AS _c5,
                      lat::VARCHAR AS _c6 FROM rail_sites"""
        ),
        "src_vehicles": sql("SELECT DISTINCT vehicle, route FROM taps"),
        "tap_clean": sql("SELECT * FROM taps"),
        "rail_clean": sql("SELECT * FROM gates"),
        "gps_clean": sql("SELECT * FROM gps"),
        "site_distance": sql(
            f"""SELECT route_id, site, next_site,
                       {oracle._km("lon", "lat", "next_lon", "next_lat")} AS to_next,
                       100.0::DOUBLE AS to_nowhere
                FROM (SELECT *, lead(site) OVER w AS next_site, lead(lon) OVER w AS next_lon,
                             lead(lat) OVER w AS next_lat
                      FROM bus_sites WINDOW w AS (PARTITION BY route_id ORDER BY site))"""
        ),
        "time_format_roundtrip": sql(
            """SELECT card, station, date || time AS text, t // 1000 * 1000 AS ms,
                      date || time AS back, date[1:6] AS month, '00000000000000' AS before_1970
               FROM gates_raw"""
        ),
        "vehicle_day": sql("SELECT * FROM taps WHERE vehicle = '00000003'"),
        "all_sites": sql("SELECT * FROM all_sites"),
        "near_sites": sql("SELECT * FROM near"),
        "gps_dwell_first": sql("SELECT * FROM dwell"),
        "gps_trip_runs": sql("SELECT * FROM runs"),
        "gps_run_fixes": sql(
            """SELECT service_date, vehicle, run,
                      count(*) OVER (PARTITION BY service_date, vehicle, run) AS fixes_in_run,
                      min(ts_ms) OVER (PARTITION BY service_date, vehicle, run) AS first_ms,
                      max(ts_ms) OVER (PARTITION BY service_date, vehicle, run) AS last_ms,
                      ts_ms, site
               FROM runs"""
        ),
        "board_asof": sql("SELECT * FROM last_fix"),
        "board_site_lookup": sql("SELECT * FROM boarded"),
        "matched_boardings": sql("SELECT * FROM boarded WHERE site_id IS NOT NULL"),
        "rail_station_join": sql("SELECT * FROM located"),
        "rail_legs": sql("SELECT * FROM rail_legs"),
        "travel_chain": sql(f"SELECT {chain} FROM chain"),
        "alight_candidates": sql("SELECT * EXCLUDE (shared_row) FROM cand"),
        "alight_inferred": sql("SELECT * FROM resolved"),
        "alight_weights": sql("SELECT * FROM weights"),
        "history_merge": sql(
            """SELECT service_date, route, site, sum(weight)::BIGINT AS weight
               FROM (SELECT * FROM weights UNION ALL
                     SELECT service_date, route, site, count(*) FROM boarded GROUP BY ALL)
               GROUP BY ALL"""
        ),
        "alight_fallback": sql("SELECT * FROM fallback"),
        "od_legs": sql("SELECT * FROM legs"),
        "od_enrich_inner": sql("SELECT * FROM enrich_inner"),
        "od_enrich_left": sql("SELECT * FROM enrich_left"),
        "transfer_labels": sql("SELECT * FROM labelled"),
        "transfer_pairs": sql("SELECT * FROM transfers"),
        "journeys": sql("SELECT * FROM journeys"),
        "od_bus_day": sql("SELECT * FROM labelled", rail=False),
        "od_bus_rail_day": sql("SELECT *, off_ms < on_ms AS off_before_on FROM labelled"),
        "od_month": sql("SELECT * FROM journeys", squeeze=1),
        "rail_legs_hot": sql("SELECT * FROM rail_legs"),
        "travel_chain_hot": sql(f"SELECT {chain} FROM chain"),
        "transfer_labels_hot": sql("SELECT * FROM labelled"),
        "transfer_pairs_hot": sql("SELECT * FROM transfers"),
        "journeys_hot": sql("SELECT * FROM journeys"),
        "feed_rejects": sql(oracle.feed_rejects_sql()),
        "read_bus_taps": sql("SELECT * FROM taps_read"),
        "read_rail_gates": sql("SELECT * FROM gates_read"),
        "read_gps": sql("SELECT * FROM gps_read"),
        "write_read_results": sql("SELECT * FROM labelled"),
        "history_log": sql(
            """SELECT service_date, route, site,
                      weight + CASE WHEN service_date = (SELECT min(service_date) FROM weights) THEN 1 ELSE 0 END AS weight
               FROM weights"""
        ),
        "od_month_files": sql("SELECT * FROM journeys", squeeze=1, day_starts_ms=DAY_STARTS * 3_600_000),
    }
