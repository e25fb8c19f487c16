import random

from tests.frames import DAY, DAY_MS, fixes, frame, rows_of, site

from tapflow.operators import boarding, gps
from tapflow.schemas import TAPS


def test_dwell_keeps_the_first_fix_of_a_visit(spark):
    got = gps.dwell_first(fixes(spark, [(0, 1), (300_000, 1), (900_000, 1), (1_500_001, 1)]))
    assert sorted(r.ts_ms for r in got.collect()) == [0, 1_500_001]


def dwell_by_hand(times):
    kept, last = [], None
    for t in sorted(times):
        if last is None or t - last > gps.DWELL_MS:
            kept.append(t)
        last = t
    return kept


def test_dwell_against_a_plain_loop(spark):
    rng = random.Random(1)
    rows = [(DAY_MS + rng.randrange(0, 80_000_000, 1000), rng.randrange(1, 8)) for _ in range(900)]
    got = gps.dwell_first(fixes(spark, rows))
    expected = [(t, site(s)) for s in range(1, 8) for t in dwell_by_hand(t for t, n in rows if n == s)]
    assert sorted((r.ts_ms, r.site) for r in got.collect()) == sorted(expected)


def runs_of(spark, stops):
    runs = gps.trip_runs(fixes(spark, [(i * 60_000, s) for i, s in enumerate(stops)]))
    return [r.run for r in runs.orderBy("ts_ms").collect()]


def test_runs(spark):
    assert runs_of(spark, [1, 2, 3, 5, 4, 6, 7, 1, 2]) == [0, 0, 0, 0, 0, 0, 0, 1, 1]
    assert runs_of(spark, [1, 3, 2, 4]) == [0, 0, 1, 1]
    assert runs_of(spark, [4]) == [0]
    assert runs_of(spark, [3, 3, 3]) == [0, 1, 2]


def test_run_fixes_are_in_time_order(spark):
    runs = gps.trip_runs(fixes(spark, [(300, 1), (400, 2), (500, 1)]))
    got = {r.run: [tuple(f) for f in r.fixes] for r in gps.run_fixes(runs).collect()}
    assert got == {0: [(300, site(1)), (400, site(2))], 1: [(500, site(1))]}


def taps(spark, times, vehicle="00000001"):
    rows = [
        {"service_date": DAY, "card": f"{i:016d}", "person": f"{i:08d}", "ts_ms": t,
         "vehicle": vehicle, "route": "00000001", "site": "000000", "fare_due": 0, "fare_paid": 0}
        for i, t in enumerate(times)
    ]
    return frame(spark, TAPS, rows)


def test_boarding_is_strictly_after_the_fix(spark):
    runs = gps.trip_runs(fixes(spark, [(DAY_MS + t, s) for t, s in ((100, 1), (200, 2), (300, 3))]))
    got = boarding.board_asof(taps(spark, [DAY_MS + t for t in (100, 200, 350)]), runs)
    assert sorted((r.ts_ms - DAY_MS, r.fix_ms - DAY_MS) for r in got.collect()) == [(200, 100), (350, 300)]


def test_boarding_against_a_plain_loop(spark):
    """Sparse fixes leave most slots empty; some taps and fixes lie outside the service day."""
    rng = random.Random(2)
    seen = sorted({DAY_MS + rng.randrange(-10**7, 10**8) for _ in range(40)})
    tapped = [DAY_MS + rng.randrange(-10**7, 12 * 10**7) for _ in range(400)]
    runs = gps.trip_runs(fixes(spark, [(t, 1 + i % 9) for i, t in enumerate(seen)]))
    got = boarding.board_asof(taps(spark, tapped), runs)
    expected = [(t, max(f for f in seen if f < t)) for t in tapped if t > seen[0]]
    assert sorted((r.ts_ms, r.fix_ms) for r in got.collect()) == sorted(expected)


def test_one_boarding_per_card_and_instant(spark):
    """A card tapped twice in one instant keeps the tap closest to its fix."""
    near = gps.trip_runs(fixes(spark, [(DAY_MS + 900, 5)], "00000001"))
    far = gps.trip_runs(fixes(spark, [(DAY_MS + 100, 6)], "00000002"))
    both = taps(spark, [DAY_MS + 1000]).union(taps(spark, [DAY_MS + 1000], "00000002"))
    got = boarding.board_asof(both.union(both), near.union(far)).collect()
    assert [(r.vehicle, r.site) for r in got] == [("00000001", site(5))]


def test_unknown_stop_keeps_the_boarding(spark):
    runs = gps.trip_runs(fixes(spark, [(DAY_MS, 1), (DAY_MS + 60_000, 2)]))
    asof = boarding.board_asof(taps(spark, [DAY_MS + 1, DAY_MS + 60_001]), runs)
    sites = spark.sql(
        "SELECT 'R' route_id, '00000001' route, 'S' site_id, '000001' site, 'A' site_name, '0' direction, "
        "1D lon, 2D lat"
    )
    got = boarding.site_lookup(asof, sites)
    assert rows_of(got.select("site", "site_id")) == [("000001", "S"), ("000002", None)]
    assert boarding.matched_boardings(got).count() == 1
