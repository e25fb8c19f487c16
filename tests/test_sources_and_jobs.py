from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.frames import DAY, frame, rows_of

from tapflow.operators import cleaning
from tapflow.plans.jobs import near_sites_table, run, run_files
from tapflow.schemas import BUS_SITES_RAW, GATES_KEPT, GATES_RAW, GPS_RAW, TAPS_RAW, VEHICLES_RAW
from tapflow.sources import feeds, tables
from tapflow.sources.event_tables import EventTables, feed_text, write_day_files, write_feed_files

DATA = "/root/testdata/sf0.001"


def write_text(df, folder, name, columns=None, header=True, sep=","):
    """The feed as a text file with made-up header names, as it would arrive."""
    path = str(folder / name)
    if columns:
        missing = [c for c in columns if c not in df.columns]
        df = df.selectExpr(*[f"'' AS {c}" if c in missing else c for c in columns])
    named = df.toDF(*[f"HEAD_{i}" for i in range(len(df.columns))])
    named.write.csv(path, header=header, sep=sep)
    return path


@pytest.fixture(scope="module")
def city(spark, tmp_path_factory):
    """All six feeds as files, and the tables they came from."""
    folder, source = tmp_path_factory.mktemp("feeds"), EventTables(spark, DATA)
    stations = source.rail_sites_raw.selectExpr("'x' AS c0", "_c1", "'x' AS c2", "_c3", "'x' AS c4", "_c5", "_c6")
    return source, {
        "taps": write_text(source.taps_raw, folder, "taps.txt", sep="\t"),
        "gates": write_text(source.gates_raw, folder, "gates.csv", GATES_RAW),
        "gps": write_text(source.gps_raw, folder, "gps.csv"),
        "bus_sites": write_text(source.bus_sites_raw, folder, "bus_sites.csv"),
        "rail_sites": write_text(stations, folder, "rail_sites.csv", header=False),
        "vehicles": write_text(source.vehicles_raw, folder, "vehicles.csv"),
    }


def test_readers_return_what_was_written(spark, city):
    source, paths = city
    assert rows_of(cleaning.clean_taps(feeds.read_bus_taps(spark, paths["taps"]))) == rows_of(source.taps)
    gates = feeds.read_rail_gates(spark, paths["gates"])
    assert gates.columns == GATES_KEPT
    assert rows_of(cleaning.clean_gates(gates)) == rows_of(source.gates)
    assert rows_of(cleaning.clean_gps(feeds.read_gps(spark, paths["gps"]))) == rows_of(source.gps_fixes)
    stops = cleaning.clean_bus_sites(feeds.read_bus_sites(spark, paths["bus_sites"]))
    assert rows_of(stops) == rows_of(source.bus_sites)
    stations = cleaning.clean_rail_sites(feeds.read_rail_sites(spark, paths["rail_sites"]))
    assert rows_of(stations) == rows_of(source.rail_sites)
    vehicles = cleaning.clean_vehicles(feeds.read_vehicles(spark, paths["vehicles"]))
    assert rows_of(vehicles) == rows_of(cleaning.clean_vehicles(source.vehicles_raw))


def test_column_counts_are_checked(spark, city, tmp_path):
    tab_separated_gps = write_text(city[0].gps_raw, tmp_path, "gps.txt", sep="\t")
    with pytest.raises(ValueError, match="expected 12 columns, found 7"):
        feeds.read_bus_taps(spark, tab_separated_gps)
    assert [len(c) for c in (TAPS_RAW, GATES_RAW, GPS_RAW, BUS_SITES_RAW, VEHICLES_RAW)] == [12, 39, 7, 12, 4]


def test_feeds_may_be_parquet(spark, city, tmp_path):
    path = str(tmp_path / "taps.parquet")
    city[0].taps_raw.write.parquet(path)
    assert feeds.read_bus_taps(spark, path, "parquet").count() == city[0].taps_raw.count()


def test_near_table_is_built_once(spark, city, tmp_path):
    source, path = city[0], str(tmp_path / "near")
    first = rows_of(near_sites_table(spark, path, source.bus_sites, source.rail_sites))
    files = sorted(f.name for f in Path(path).iterdir())
    again = rows_of(near_sites_table(spark, path, source.bus_sites.limit(0)))
    assert first == again and first
    assert files == sorted(f.name for f in Path(path).iterdir())


def test_read_or_build_reports_other_errors(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)no_such_format"):
        tables.read_or_build(spark, str(tmp_path), lambda: None, "no_such_format")


def history(spark, weight):
    return frame(spark, ["route", "site", "weight"], [{"route": "r", "site": "s", "weight": weight}])


def test_history_versions(spark, tmp_path):
    path = str(tmp_path / "history")
    assert tables.read_history(spark, path) is None
    tables.write_history(history(spark, 1), path)
    saved = tables.read_history(spark, path)
    # The next version is computed from the one being read.
    tables.write_history(saved.selectExpr("route", "site", "weight + 1 AS weight"), path)
    assert rows_of(tables.read_history(spark, path)) == [("r", "s", 2)]


def test_writing_a_day_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "days")
    table = spark.sql("SELECT DATE '2024-01-01' AS service_date, 1 AS x UNION ALL SELECT DATE '2024-01-02', 2")
    tables.write_days(table, path)
    tables.write_days(table.filter("x = 2").selectExpr("service_date", "3 AS x"), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 3]
    # a run of both days that finds rows of the first only leaves none of the second
    days = [r[0] for r in table.select("service_date").distinct().collect()]
    tables.write_days(table.filter("x = 1"), path, days=days)
    assert [r.x for r in spark.read.parquet(path).collect()] == [1]


@pytest.mark.parametrize("with_rail", [False, True])
def test_run_writes_the_three_results(spark, city, tmp_path, with_rail):
    import __spark_entry__ as entry

    source, out = city[0], str(tmp_path)
    rail = {"gates": source.gates, "rail_sites": source.rail_sites} if with_rail else {}
    options = dict(near_path=f"{out}/near", history_path=f"{out}/history", fmt="csv", **rail)
    run(source.taps, source.gps_fixes, source.bus_sites, f"{out}/first", **options)

    plan = entry._plan(spark, DATA, with_rail)
    for name, ours, columns in (
        ("legs", tables.legs_output(plan.labelled), 22),
        ("transfers", tables.transfers_output(plan.transfers), 21),
        ("journeys", tables.journeys_output(plan.journeys), 19),
    ):
        written = spark.read.csv(f"{out}/first/{name}", header=True)
        assert len(written.columns) == columns + 1  # and the day
        kinds = [f"cast({c} AS string) AS {c}" for c in written.columns]
        empty_is_null = [f"nullif({c}, '') AS {c}" for c in written.columns]
        assert rows_of(written.selectExpr(*kinds)) == rows_of(ours.selectExpr(*kinds).selectExpr(*empty_is_null))

    # A second run of the same day replaces what the first one saved of it.
    assert tables.read_history(spark, f"{out}/history").agg({"weight": "sum"}).first()[0] > 0
    once = tables.read_history(spark, f"{out}/history").agg({"weight": "sum"}).first()[0]
    run(
        source.taps, source.gps_fixes, source.bus_sites, f"{out}/second", days=[DAY],
        intermediates=True, **options,
    )
    for name, step in (("runs", plan.trip_runs), ("boarded", plan.boarded)):
        assert spark.read.csv(f"{out}/second/{name}", header=True).count() == step.count()
    assert spark.read.csv(f"{out}/second/rides", header=True).count() >= plan.legs.count()
    assert tables.read_history(spark, f"{out}/history").agg({"weight": "sum"}).first()[0] == once
    assert DAY in {r[0] for r in spark.read.parquet(f"{out}/second/legs_ms").select("service_date").distinct().collect()}


@pytest.fixture(scope="module")
def damaged(spark, city, tmp_path_factory):
    """The taps, gps and gate feeds as the adapter writes them, some lines cut, some times and cards spoiled."""
    folder, source = tmp_path_factory.mktemp("damaged"), city[0]
    paths = {f: str(folder / f) for f in ("taps", "gps", "gates")}
    for feed, rows in (("taps", source.taps_raw), ("gps", source.gps_raw), ("gates", source.gates_raw)):
        write_feed_files(rows, feed, paths[feed])
    return paths


def test_rejected_lines_keep_their_file_and_text(spark, city, damaged):
    source = city[0]
    for feed, raw, sep, cut in (("taps", source.taps_raw, "\t", 5), ("gates", source.gates_raw, ",", 20), ("gps", source.gps_raw, ",", 3)):
        checked = feeds.read_checked(spark, damaged[feed], feed)
        rejects = checked.rejects.collect()
        texts = {r.value for r in feed_text(raw, feed).collect()}
        assert rejects and all(r.line in texts and len(r.line.split(sep)) == cut for r in rejects)
        assert all(r.file.startswith("file:") and damaged[feed] in r.file for r in rejects)
        assert checked.rows.count() + len(rejects) == raw.count()
        assert checked.rows.columns == feeds.FEEDS[feed][1]


def test_run_files_counts_what_it_rejects(spark, city, damaged, tmp_path):
    import __spark_entry__ as entry

    source, out = city[0], str(tmp_path / "out")
    counts = run_files(spark, damaged, source.bus_sites, out, source.rail_sites)
    lines = {f: feeds.read_lines(spark, damaged[f], f) for f in damaged}
    expected = {r.feed: r for r in cleaning.feed_rejects(lines["taps"], lines["gps"], lines["gates"]).collect()}
    for feed, seen in counts.items():
        e = expected[feed]
        assert seen == {"rows": e.rows, "rejected": e.rejected, "bad_time": e.bad_time, "bad_card": e.bad_card}
        assert seen["rejected"] > 0 and seen["bad_time"] > 0
        assert spark.read.parquet(f"{out}/rejects/{feed}").count() == seen["rejected"]
    assert spark.read.parquet(f"{out}/legs").count() > 0
    assert entry.queries()["feed_rejects"] is not None


def test_published_results_change_only_together(spark, city, tmp_path, monkeypatch):
    from tapflow.plans import jobs

    source, out = city[0], str(tmp_path / "published")
    rail = {"gates": source.gates, "rail_sites": source.rail_sites}
    run(source.taps, source.gps_fixes, source.bus_sites, out, publish=True, **rail)
    first = {name: rows_of(tables.read_published(spark, out, name)) for name in ("legs", "transfers", "journeys", "legs_ms")}
    assert all(first.values()) and tables.manifest(spark, out)["version"] == 1

    # A second run fails after its legs are staged and before transfers: readers see the first run only.
    def broken(*args, **kwargs):
        raise RuntimeError("lost between two sinks")

    monkeypatch.setattr(jobs, "transfer_pairs", broken)
    with pytest.raises(RuntimeError, match="between two sinks"):
        run(source.taps.limit(10), source.gps_fixes, source.bus_sites, out, publish=True, **rail)
    assert {name: rows_of(tables.read_published(spark, out, name)) for name in first} == first
    monkeypatch.undo()

    # A run of one day with no taps and gate records publishes that day as empty; other days stay as they were.
    days = sorted({r[0] for r in source.taps.select("service_date").distinct().collect()})
    others = rows_of(tables.read_published(spark, out, "legs").filter(F.col("service_date") != days[0]))
    run(source.taps.filter("false"), source.gps_fixes, source.bus_sites, out, publish=True, days=[days[0]],
        gates=source.gates.filter("false"), rail_sites=source.rail_sites)
    assert tables.manifest(spark, out)["version"] == 2
    legs = tables.read_published(spark, out, "legs")
    assert legs.filter(F.col("service_date") == days[0]).count() == 0
    assert rows_of(legs.filter(F.col("service_date") != days[0])) == others

    # An older manifest version is never overwritten.
    publication = tables.Publication(spark, out)
    publication.base = {"version": 1, "results": {}}
    with pytest.raises(Exception):
        publication.commit()


def test_history_log_writes_only_its_days(spark, tmp_path):
    from datetime import date as day

    path = str(tmp_path / "log")
    rows = [(day(2024, 1, d), f"R{d}", f"S{i}", i) for d in (1, 2, 3) for i in range(50)]
    weights = spark.createDataFrame(rows, "service_date date, route string, site string, weight long")

    def size(run):
        return sum(f.stat().st_size for f in Path(path).glob(f"service_date=*/run={run}/*.parquet"))

    first = tables.write_history_log(weights, path)
    d1 = weights.filter("service_date = DATE'2024-01-01'")
    sizes = [size(tables.write_history_log(d1.withColumn("weight", F.col("weight") + k), path, [day(2024, 1, 1)])) for k in range(1, 4)]
    assert max(sizes) <= 1.05 * min(sizes) and max(sizes) < size(first)  # a run writes its own days, however many came before
    read = {(r.service_date.day, r.site): r.weight for r in tables.read_history_log(spark, path).collect()}
    assert read[(1, "S5")] == 8 and read[(2, "S5")] == 5 and len(read) == 150

    tables.write_history_log(weights.filter("false"), path, [day(2024, 1, 2)])  # day 2 has no weights now
    assert {d for d, _ in {(r.service_date.day, 0) for r in tables.read_history_log(spark, path).collect()}} == {1, 3}
    removed = tables.compact_history_log(spark, path, keep=1)
    assert len(removed) == 3 + 1  # three older runs of day 1, one of day 2
    assert sorted(tables.read_history_log(spark, path).collect()) == sorted(
        tables.read_history_log(spark, path).collect())
    assert tables.read_history_log(spark, str(tmp_path / "none")) is None


def test_day_of_a_file_comes_from_its_folder(spark, city, tmp_path):
    from datetime import date as day

    paths = ["s3a://b/taps/2019-11-1/part-0.csv", "file:/x/day=2024-01-31/part-1.csv", "file:/x/2024-01-31x/a.csv", "file:/x/a.csv"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "file string").selectExpr(feeds.day_of_file()).collect()]
    assert got == [day(2019, 11, 1), day(2024, 1, 31), None, None]

    # Records before three o'clock are written to the day before, and read back with that day.
    source = EventTables(spark, DATA, squeeze=1)
    write_day_files(source.taps_raw, "taps", str(tmp_path / "taps"))
    read = feeds.read_day_folders(spark, str(tmp_path / "taps"), "taps").filter("line IS NULL")
    taps = cleaning.clean_taps(read, day=feeds.day_of_file())
    hours = taps.selectExpr("service_date", "hour(timestamp_millis(ts_ms)) AS h", "to_date(timestamp_millis(ts_ms)) AS d").collect()
    assert len(hours) == source.taps.count()
    assert all((r.service_date == r.d) == (r.h >= 3) for r in hours) and any(r.h < 3 for r in hours)


def test_jobs_side_by_side_leave_no_scratch_tables(spark, city, tmp_path):
    import threading

    source = city[0]
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.iterdir())
    failures = []

    def job(name):
        try:
            run(source.taps, source.gps_fixes, source.bus_sites, str(tmp_path / name), source.gates, source.rail_sites)
        except Exception as error:  # noqa: BLE001 - reported below
            failures.append(error)

    threads = [threading.Thread(target=job, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures
    assert set(folder.iterdir()) == before
    assert all(spark.read.parquet(str(tmp_path / n / "legs")).count() > 0 for n in ("a", "b"))
