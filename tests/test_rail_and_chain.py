import random

from pyspark.sql import functions as F
from tests.frames import DAY, boarding, boardings, frame, rows_of

from tapflow.operators.chain import END_OF_TIME_MS, travel_chain, with_rail_boardings
from tapflow.operators.ordered import hot_keys
from tapflow.operators.rail import rail_legs, station_join
from tapflow.schemas import PERSON_DAY

GATES = ["service_date", "card", "person", "card_type", "ts_ms", "station", "in_out", "fare_due", "fare_paid"]


def gate(ts, code, station="0101", person="00000001", **more):
    return {
        "service_date": DAY, "card": "00000000" + person, "person": person, "card_type": "01",
        "ts_ms": ts, "station": station, "in_out": code, "fare_due": ts, "fare_paid": 1,
    } | more


def located(spark, rows):
    sites = spark.sql(
        """SELECT lpad(code, 16, '0') AS site_id, concat('N', code) AS site_name, 1D AS lon, 2D AS lat
           FROM VALUES ('0101'), ('0102'), ('0203') AS t(code)"""
    )
    return station_join(frame(spark, GATES, rows), sites)


def test_entry_followed_by_exit_is_a_leg(spark):
    rows = [gate(1, "21"), gate(2, "21"), gate(3, "22", "0203"), gate(4, "22")]
    (leg,) = rail_legs(located(spark, rows)).collect()
    assert (leg.on_ms, leg.off_ms, leg.direction, leg.fare_due) == (2, 3, "2", 3)
    assert (leg.on_site_id, leg.off_route, leg.off_site) == ("0" * 12 + "0101", "00000002", "000003")
    assert (leg.off_site_name, leg.vehicle, leg.change_type) == ("N0203", "00000000", "")


def test_unknown_stations_are_dropped_before_pairing(spark):
    rows = [gate(1, "21"), gate(2, "22", "9999"), gate(3, "22", "0102")]
    (leg,) = rail_legs(located(spark, rows)).collect()
    assert (leg.on_ms, leg.off_ms) == (1, 3)


def test_the_larger_card_number_is_kept(spark):
    rows = [gate(1, "21"), gate(2, "22", card="9999999900000001")]
    assert rail_legs(located(spark, rows)).first().card == "9999999900000001"


def hot_gates(rng):
    """One person with a thousand records, many of them copies, beside ordinary people."""
    rows = [
        gate(rng.randrange(0, 300), rng.choice(["21", "22"]), rng.choice(["0101", "0102"]))
        for _ in range(600)
    ]
    rows += [gate(77, "21")] * 200 + [gate(78, "22")] * 200
    rows += [
        gate(rng.randrange(0, 300), rng.choice(["21", "22"]), person=f"{p:08d}")
        for p in range(2, 30) for _ in range(6)
    ]
    return [r | {"fare_due": r["ts_ms"]} for r in rows]


def test_hot_person_gives_the_same_rail_legs(spark):
    gates = located(spark, hot_gates(random.Random(3))).persist()
    hot = hot_keys([gates], PERSON_DAY, limit=100)
    assert [r.person for r in hot.collect()] == ["00000001"]
    assert rows_of(rail_legs(gates, hot)) == rows_of(rail_legs(gates))


def test_no_hot_keys(spark):
    assert hot_keys([located(spark, [gate(1, "21")])], PERSON_DAY, limit=1) is None


def chained(spark, rows, hot=None):
    return {r.ts_ms: r for r in travel_chain(boardings(spark, rows), hot).collect()}


def test_chain(spark):
    got = chained(spark, [
        boarding(10, "A", "1"), boarding(20, "B", "2"), boarding(30, "C", "3", direction="2"),
        boarding(40, "D", "4"),
    ])
    assert sorted(got) == [10, 20, 40]
    assert [(got[t].target_route, got[t].target_site, got[t].next_ms) for t in (10, 20, 40)] == [
        ("B", "2", 20), ("C", "3", 30), ("A", "1", END_OF_TIME_MS),
    ]


def test_unmatched_boardings_stay_in_the_chain(spark):
    got = chained(spark, [boarding(10, "A", "1", direction=None, site_id=None), boarding(20, "B", "2")])
    assert sorted(got) == [10, 20]


def test_boardings_in_one_instant_are_marked(spark):
    rows = [boarding(10, "A", "1"), boarding(10, "A", "2"), boarding(11, "A", "3")]
    got = travel_chain(boardings(spark, rows)).collect()
    assert sorted((r.site, r.shared_tap) for r in got) == [("1", True), ("2", True), ("3", False)]


def test_hot_person_gives_the_same_chain(spark):
    rng = random.Random(4)
    rows = [
        boarding(rng.randrange(2000), rng.choice("ABC"), str(rng.randrange(9)), rng.choice(["0", "1", "2", None]),
                 fare_due=i)
        for i in range(700)
    ]
    rows += [boarding(rng.randrange(2000), "A", "1", person=f"{p:08d}") for p in range(2, 40) for _ in range(3)]
    table = boardings(spark, rows).persist()
    hot = hot_keys([table], PERSON_DAY, limit=50)
    assert rows_of(travel_chain(table, hot)) == rows_of(travel_chain(table))


def test_missing_person_can_be_hot(spark):
    rows = [boarding(i, "A", str(i % 7), person="00000009") | {"person": None} for i in range(90)]
    rows += [boarding(i, "B", str(i)) for i in range(4)]
    table = boardings(spark, rows).persist()
    hot = hot_keys([table], PERSON_DAY, limit=50)
    assert hot.count() == 1
    assert rows_of(travel_chain(table, hot)) == rows_of(travel_chain(table))


def test_rail_boardings_join_the_chain(spark):
    legs = rail_legs(located(spark, [gate(15, "21", "0203"), gate(18, "22")]))
    both = with_rail_boardings(boardings(spark, [boarding(10, "A", "1"), boarding(20, "B", "2")]), legs)
    got = travel_chain(both).filter(F.col("ts_ms") == 10).first()
    assert (got.target_route, got.target_site, got.next_ms) == ("00000002", "000003", 15)
