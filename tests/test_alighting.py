import random

from pyspark.sql import functions as F
from tests.frames import DAY, boarding, fixes, frame, rows_of, site

from tapflow.operators import alighting, gps
from tapflow.operators.legs import enrich
from tapflow.schemas import CHAINED, SITES

NEAR = [*SITES, *[f"{c}2" for c in SITES], "distance"]
ROUTE = "00000001"


def chain(spark, rows):
    return frame(spark, CHAINED, rows)


def link(ts=1, stop=1, next_ms=300, target_route="T", target_site=site(9), **more):
    row = boarding(ts, ROUTE, site(stop))
    return row | {
        "target_route": target_route, "target_site": target_site, "next_ms": next_ms,
        "shared_tap": False,
    } | more


def near(spark, rows):
    """rows: (site2, distance[, near site])"""
    return frame(spark, NEAR, [
        {"route": "T", "site": near_site, "route2": ROUTE, "site_id2": f"{ROUTE}{site(s)}",
         "site2": site(s), "direction2": "0", "distance": d}
        for s, d, near_site in ((*r, site(1))[:3] for r in rows)
    ])


def run_fixes(spark, rows):
    runs = fixes(spark, rows).withColumn("run", F.lit(0))
    return gps.run_fixes(runs)


def settle(spark, rows, seen, pairs):
    nearby = alighting.nearby_stops(near(spark, pairs))
    return alighting.one_leg_per_tap(
        alighting.infer(chain(spark, rows), run_fixes(spark, seen), nearby)
    )


SEEN = [(100, 1), (200, 2), (300, 3)]


def test_nearest_candidate_and_latest_fix(spark):
    got = alighting.resolved_legs(settle(spark, [link(stop=0)], SEEN, [(3, 0.5), (1, 0.9)])).first()
    assert (got.off_site, got.off_ms, got.distance) == (site(2), 200, 0.5)


def test_candidates(spark):
    got = alighting.candidates(
        chain(spark, [link(stop=2), link(ts=2, stop=2, target_route="U")]),
        near(spark, [(1, 0.1), (2, 0.2), (3, 0.3), (4, 0.4, site(10))]),
    )
    assert rows_of(got.select("ts_ms", "site2", "distance")) == [(1, site(3), 0.3), (2, None, 0.0)]


def test_numbers_not_text_decide_which_is_nearer(spark):
    pairs = [(3, 100.0), (2, 2.0)]
    assert alighting.resolved_legs(settle(spark, [link(stop=0)], SEEN, pairs)).first().distance == 2.0


def test_without_a_usable_fix_the_tap_stays_open(spark):
    row = settle(spark, [link(stop=0, next_ms=100)], SEEN, [(3, 0.5)]).first()
    assert row.off is None and row.visited == []


def weights(spark, rows):
    return frame(spark, ["service_date", "route", "site", "weight"], [
        {"service_date": DAY, "route": ROUTE, "site": site(s), "weight": w} for s, w in rows
    ])


def fall_back(spark, rows, history, **options):
    open_taps = settle(spark, rows, SEEN, [])
    return alighting.fallback_legs(
        open_taps, alighting.history_by_route(weights(spark, history)), **options
    )


def test_last_resort_is_the_latest_fix_beyond_the_boarding(spark):
    row = fall_back(spark, [link(stop=1, next_ms=250)], [(9, 5)]).first()
    assert (row.off_site, row.off_ms, row.weight) == (site(2), 200, None)


def test_nothing_beyond_is_an_unknown_stop(spark):
    rides = fall_back(spark, [link(stop=1, next_ms=150)], [(9, 5)])
    assert rows_of(rides.select("off_site", "off_ms")) == [("000000", 2_222_222_222_222)]
    sites = frame(spark, SITES, [{"route": ROUTE, "site": site(2)}])
    assert enrich(rides, sites).count() == 0
    assert enrich(rides, sites, "left").count() == 1


def test_no_downstream_history_gives_no_leg(spark):
    rows, history = [link(stop=1, next_ms=250)], [(1, 5)]
    assert fall_back(spark, rows, history).count() == 0
    kept = fall_back(spark, rows, history, keep_unmatched=True)
    assert rows_of(kept.select("off_site", "off_ms")) == [(site(2), 200)]
    other = fall_back(spark, [link(stop=1, next_ms=250, route="00000005")], history, keep_unmatched=True)
    assert other.count() == 1


def test_draw_is_proportional_and_repeatable(spark):
    rows = [link(ts=i, stop=0) for i in range(4000)]
    history = [(1, 10), (2, 30), (9, 500)]
    first = fall_back(spark, rows, history).persist()
    share = first.filter(F.col("off_site") == site(2)).count() / 4000
    assert abs(share - 0.75) < 0.03
    assert {r.off_site for r in first.select("off_site").distinct().collect()} == {site(1), site(2)}
    assert {r.weight for r in first.select("weight").distinct().collect()} == {10, 30}
    assert rows_of(first) == rows_of(fall_back(spark, rows[::-1], history))


def test_one_leg_per_person_and_instant(spark):
    """A stop listed in both directions makes two rows of one tap; the nearer alighting is kept."""
    rows = [
        link(stop=0, shared_tap=True, direction="1"),
        link(stop=0, shared_tap=True),
        link(ts=2, stop=0, shared_tap=True, direction="1"),
        link(ts=2, stop=0, shared_tap=True, direction="1", card="1" * 16),
    ]
    kept = settle(spark, rows, SEEN, [(3, 0.5)]).persist()
    assert rows_of(kept.select("ts_ms", "direction", "card", F.col("off").isNull().alias("x"))) == [
        (1, "0", "0000000000000001", False), (2, "1", "0000000000000001", True),
    ]


def test_weights_and_history(spark):
    resolved = settle(spark, [link(ts=i, stop=0) for i in range(5)], SEEN, [(3, 0.5)])
    today = alighting.alight_weights(alighting.resolved_legs(resolved))
    assert rows_of(today.select("site", "weight")) == [(site(2), 5)]
    earlier = weights(spark, [(2, 7), (3, 1)])
    merged = alighting.merge_history(today, earlier)
    assert rows_of(merged.select("site", "weight")) == [(site(2), 12), (site(3), 1)]
    undated = alighting.without_days(merged)
    assert rows_of(alighting.on_days(undated, [DAY]).select(*merged.columns)) == rows_of(merged)


def test_arrays_equal_candidate_rows(spark):
    """`infer` keeps candidates in arrays; the same from joined rows, one by one."""
    rng = random.Random(8)
    rows = [
        link(ts=i, stop=rng.randrange(8), next_ms=rng.randrange(50, 1000),
             target_site=site(rng.randrange(6)), vehicle="00000001")
        for i in range(300)
    ]
    seen = [(50 * i, rng.randrange(1, 12)) for i in range(12)]
    pairs = [(rng.randrange(12), round(rng.random(), 1), site(rng.randrange(6))) for _ in range(40)]
    got = alighting.resolved_legs(settle(spark, rows, seen, pairs))
    cands = alighting.candidates(chain(spark, rows), near(spark, pairs)).collect()
    expected = {}
    for c in cands:
        hits = [(t, site(s)) for t, s in seen if c.site2 and t < c.next_ms and site(s) <= c.site2]
        if c.site2 and c.site_id <= c.site_id2 and hits:
            rank = (c.distance, c.site2, c.near_site)
            if c.ts_ms not in expected or rank < expected[c.ts_ms][0]:
                expected[c.ts_ms] = (rank, max(hits))
    assert rows_of(got.select("ts_ms", "off_ms", "off_site", "distance")) == sorted(
        ((ts, off, stop, rank[0]) for ts, (rank, (off, stop)) in expected.items()), key=repr
    )
    assert expected
