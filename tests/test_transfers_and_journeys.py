import random

import pytest
from tests.frames import leg, legs, rows_of

from tapflow.operators.journeys import journeys
from tapflow.operators.ordered import hot_keys
from tapflow.operators.transfers import transfer_labels, transfer_pairs
from tapflow.schemas import PERSON_DAY

MINUTE = 60_000


def test_labels(spark):
    stops = [(0, "A", "0"), (30, "B", "2"), (60, "C", "1"), (61, "C", "0"), (121, "D", "0"), (182, "E", "0")]
    table = legs(spark, [leg(m * MINUTE, m * MINUTE, stop, direction=d) for m, stop, d in stops])
    got = [r.change_type for r in transfer_labels(table).orderBy("on_ms").collect()]
    assert got == ["0", "1", "2", "0", "3", "0"]


def test_a_missing_direction_counts_as_rail(spark):
    table = legs(spark, [leg(0, 1, "A", direction=None), leg(2, 3, "B", direction="2")])
    assert [r.change_type for r in transfer_labels(table).orderBy("on_ms").collect()] == ["0", "4"]


def test_pairs_need_the_previous_leg_to_be_over(spark):
    kept = legs(spark, [leg(0, 25, "A"), leg(30, 40, "B")])
    dropped = legs(spark, [leg(0, 35, "A"), leg(30, 40, "B")])
    (row,) = transfer_pairs(kept).collect()
    assert (row.pre_on_ms, row.pre_off_ms, row.curr_on_ms, row.curr_on_site_id) == (0, 25, 30, "B")
    assert transfer_pairs(dropped).count() == 0


def test_card_of_a_pair(spark):
    def card(first, second):
        rows = [leg(0, 1, "A", direction=first, card="first"), leg(2, 3, "B", direction=second, card="second")]
        return transfer_pairs(legs(spark, rows)).first().card

    assert [card("0", "0"), card("0", "2"), card("2", "1"), card("2", "2")] == ["first", "second", "first", "first"]


def test_journeys(spark):
    table = legs(spark, [
        leg(0, 10, "A", "A1", fare=5), leg(1_800_000, 20, "B", "B1", fare=7),
        leg(3_000_000, 30, "C", "C1", fare=1), leg(4_000_000, 40, "D", "D1", fare=2),
    ])
    def got(**options):
        return rows_of(journeys(table, **options).select("on_ms", "on_site", "off_site", "fare_due", "fare_paid"))

    assert got() == [(0, "A", "C1", 6, 6), (4_000_000, "D", "D1", 2, 2)]
    assert got(fare="all_legs") == [(0, "A", "C1", 13, 13), (4_000_000, "D", "D1", 2, 2)]


def test_unknown_fare_rule(spark):
    with pytest.raises(ValueError):
        journeys(legs(spark, []), fare="half")


def test_the_head_decides_not_the_leg_before(spark):
    minutes = [(0, "A"), (40, "B"), (70, "C"), (90, "B"), (95, "C"), (100, "D")]
    table = legs(spark, [leg(m * MINUTE, m * MINUTE, stop) for m, stop in minutes])
    got = rows_of(journeys(table).select("on_site", "off_site"))
    assert got == [("A", "B"), ("C", "B"), ("C", "D")]


def merged_by_hand(rows):
    """(on_ms, on_site) -> list of (head, last, size)"""
    done, head, last, size = [], None, None, 0
    for row in rows:
        if head and row[0] - head[0] <= 3_600_000 and row[1] != head[1]:
            last, size = row, size + 1
            continue
        if head:
            done.append((head, last, size))
        head, last, size = row, row, 1
    return done + [(head, last, size)]


@pytest.mark.parametrize("step, stops", [(40_000, 6), (900_000, 50), (2_000, 3), (3_000_000, 2)])
def test_hot_person_gives_the_same_journeys(spark, step, stops):
    rng = random.Random(step)
    now, rows = 0, []
    for i in range(400):
        now += 1 + rng.randrange(step)
        rows.append(leg(now, now + 1, f"s{rng.randrange(stops)}", f"end{i}", fare=i))
    rows += [leg(i * 1000, 5, "x", person=f"{p:08d}") for p in range(2, 9) for i in range(4)]
    table = legs(spark, rows).persist()
    hot = hot_keys([table], PERSON_DAY, limit=100)
    for fare in ("head_and_last", "all_legs"):
        assert rows_of(journeys(table, fare, hot)) == rows_of(journeys(table, fare))
    mine = journeys(table, hot=hot).filter("person = '00000001'")
    expected = merged_by_hand([(r["on_ms"], r["on_site_id"]) for r in rows[:400]])
    assert rows_of(mine.select("on_ms", "off_ms")) == sorted(
        ((head[0], last[0] + 1) for head, last, _ in expected), key=repr
    )


def test_hot_person_gives_the_same_labels_and_pairs(spark):
    rng = random.Random(9)
    rows = [
        leg(on, on + rng.randrange(-500_000, 2_000_000), f"s{rng.randrange(5)}",
            direction=rng.choice(["0", "1", "2", None]), fare=i)
        for i, on in enumerate(rng.randrange(0, 20_000_000, 1000) for _ in range(500))
    ]
    table = legs(spark, rows).persist()
    hot = hot_keys([table], PERSON_DAY, limit=100)
    assert rows_of(transfer_labels(table, hot)) == rows_of(transfer_labels(table))
    pairs = rows_of(transfer_pairs(table, hot))
    assert pairs == rows_of(transfer_pairs(table))
    labelled = transfer_labels(table).filter("change_type != '0'")
    assert {p[13] for p in pairs} <= {r.on_ms for r in labelled.collect()}


def test_legs_of_all_journeys_add_up(spark):
    rng = random.Random(10)
    rows = [
        leg(rng.randrange(0, 30_000_000), 1, f"s{rng.randrange(4)}", person=f"{rng.randrange(20):08d}", fare=1)
        for _ in range(200)
    ]
    total = journeys(legs(spark, rows), fare="all_legs").agg({"fare_due": "sum"}).first()[0]
    assert total == 200
