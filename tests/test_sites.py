import math
import random

from pyspark.sql import functions as F

from tapflow.operators.sites import all_sites, near_sites
from tapflow.schemas import SITES

KINDS = ", ".join(f"{c} {'double' if c in ('lon', 'lat') else 'string'}" for c in SITES)


def stops(spark, rows):
    """rows: (name, lon, lat)"""
    return spark.createDataFrame(
        [("R", "r", f"id{i}", str(i), name, "0", lon, lat) for i, (name, lon, lat) in enumerate(rows)], KINDS
    )


def km(a, b):
    if not all(v for v in (*a, *b)):
        return 100.0
    (x1, y1), (x2, y2) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((y1 - y2) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x1 - x2) / 2) ** 2
    return math.floor(2 * 6378.137 * math.sin(math.sqrt(h)) * 100 + 0.5) / 100


def by_hand(left, right):
    pairs = []
    for i, (name, *p) in enumerate(left):
        for j, (name2, *q) in enumerate(right):
            d = km(p, q)
            if d <= 1.0 and d != 0 or (name is not None and name == name2):
                pairs.append((f"id{i}", f"id{j}", d))
    return sorted(pairs)


def pairs_of(df):
    return sorted((r.site_id, r.site_id2, r.distance) for r in df.collect())


def test_same_place_needs_the_same_name(spark):
    rows = [("A", 106.5, 29.5), ("B", 106.5, 29.5), ("A", 106.5, 29.5)]
    assert pairs_of(near_sites(stops(spark, rows), stops(spark, rows))) == by_hand(rows, rows)


def check_cloud(spark, lon, lat, spread, seed):
    rng = random.Random(seed)
    def cloud(n):
        return [
            (f"n{rng.randrange(60)}", (lon + rng.uniform(-spread, spread) + 540) % 360 - 180,
             lat + rng.uniform(-0.03, 0.03))
            for _ in range(n)
        ]
    left, right = cloud(150), cloud(120)
    left += [("n1", 0.0, lat), (None, lon, lat), (None, None, None)]
    right += [("n1", lon, 0.0), (None, lon, lat)]
    left, right = [
        [(n, x if x is None else round(x, 6), y if y is None else round(y, 6)) for n, x, y in t]
        for t in (left, right)
    ]
    assert pairs_of(near_sites(stops(spark, left), stops(spark, right))) == by_hand(left, right)


def test_grid_equals_all_pairs_in_the_city(spark):
    check_cloud(spark, 106.5, 29.5, 0.03, 5)


def test_grid_equals_all_pairs_across_the_date_line(spark):
    check_cloud(spark, 180.0, -17.5, 0.03, 6)


def test_grid_equals_all_pairs_far_north(spark):
    check_cloud(spark, 20.0, 78.0, 0.15, 7)


def test_copies_of_stops_give_one_pair(spark):
    rows = [("A", 106.5, 29.5), ("B", 106.503, 29.5)]
    once, twice = stops(spark, rows), stops(spark, rows).union(stops(spark, rows))
    assert pairs_of(near_sites(twice, twice)) == pairs_of(near_sites(once, once))


def test_all_sites(spark):
    rows = stops(spark, [("A", 1.0, 2.0)])
    assert all_sites(rows, rows).count() == 2


def test_a_full_cell_and_a_common_name_are_dealt_in_pieces(spark, monkeypatch):
    from tapflow.operators import sites

    rnd = random.Random(4)
    crowded = [("Main" if i % 3 else f"S{i}", 106.5 + rnd.random() * 0.005, 29.5 + rnd.random() * 0.005) for i in range(150)]
    spread = [(f"T{i}", 106.0 + rnd.random(), 29.0 + rnd.random()) for i in range(60)]
    rows = crowded + spread
    plain = pairs_of(near_sites(stops(spark, rows), stops(spark, rows)))
    monkeypatch.setattr(sites, "SPLIT_ROWS", 7)
    assert pairs_of(near_sites(stops(spark, rows), stops(spark, rows))) == plain == by_hand(rows, rows)
    a = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 0)], "k int, v int")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, w string")
    joined = sites.split_join(a.withColumn("p", F.spark_partition_id()), b, ["k"], split_rows=10)
    assert sorted((r.k, r.v, r.w) for r in joined.collect()) == sorted((r.k, r.v, r.w) for r in a.join(b, "k").collect())
