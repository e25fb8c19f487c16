"""Stop dictionaries and the table of stops near each other."""

from pyspark.sql import DataFrame, functions as F

from tapflow import functions as fn
from tapflow.functions.geo import EARTH_RADIUS_KM
from tapflow.operators.sizing import cut_lineage
from tapflow.schemas import SITES

NEAR_KM = 1.0
# Rounding to two places lets 1.005 km through, so a cell must be a little wider than that.
CELL_KM = 1.05
KM_PER_DEGREE = EARTH_RADIUS_KM * 3.141592653589793 / 180
BAND_DEGREES = CELL_KM / KM_PER_DEGREE


def all_sites(bus_sites: DataFrame, rail_sites: DataFrame) -> DataFrame:
    return bus_sites.unionByName(rail_sites)


# Number of cells round the globe in a latitude `band`, none narrower than `CELL_KM` anywhere in the
# band or its two neighbours, and the cell of a `lon` among them.
_CELLS = f"""cast(greatest(1, floor(
    cos(radians(least(90, (abs(band + 0.5D) + 1.5D) * {BAND_DEGREES}D))) * 360 / {BAND_DEGREES}D
)) AS bigint) AS cells"""
_CELL = "pmod(cast(floor((lon + 180) / (360D / cells)) AS bigint), cells)"
_BAND = f"cast(floor(lat / {BAND_DEGREES}D) AS bigint)"
_KM = fn.site_distance("lon", "lat", "lon2", "lat2")
#: Rows of one key on the left side of a near-stop join that one task takes; a key with more is dealt in pieces.
SPLIT_ROWS = 5_000
#: Hot keys (one row each) up to which their table is broadcast to both sides; above, it is joined by a shuffle.
BROADCAST_KEYS = 100_000
_IS_NEAR = f"(distance <= {NEAR_KM}D AND distance != 0)"


def split_join(a: DataFrame, b: DataFrame, keys: list[str], split_rows: int | None = None) -> DataFrame:
    """`a` joined with `b` on `keys`, where a key with more than `split_rows` rows in `a` is dealt over that many pieces:
    its `a` rows go to a piece by a hash of the row, and its `b` rows are copied to every piece.

    One cell full of stops, or one name that thousands of stops share, so spreads over many tasks; other keys join as
    before (one piece). The result is the same rows as the plain join.
    """
    split_rows = split_rows or SPLIT_ROWS
    # Written out, because both sides read it: else the rows of `a` would be made and counted again for each.
    hot = cut_lineage(
        a.groupBy(*keys).count().filter(F.col("count") > split_rows)
        .select(*keys, F.ceil(F.col("count") / split_rows).cast("int").alias("_pieces"))
    )
    if hot.count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    a = a.join(hot, keys, "left").withColumn("_piece", F.pmod(F.xxhash64(*[F.col(c) for c in a.columns]), pieces))
    b = b.join(hot, keys, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return a.drop("_pieces").join(b.drop("_pieces"), [*keys, "_piece"]).drop("_piece")


def _near_points(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of distinct positions at most `NEAR_KM` but not 0.00 km apart (lon, lat, lon2, lat2).

    Positions are binned in a latitude band / longitude cell grid; a position meets the 3 x 3 cells
    around it, wrapping round the globe, and only then is the distance computed.
    """
    # Stops sharing one position meet others once, not once per stop.
    a, b = (
        df.filter("lon != 0 AND lat != 0").select("lon", "lat").distinct() for df in (left, right)
    )
    around = f"array_distinct(transform(array(-1, 0, 1), d -> pmod({_CELL} + d, cells)))"
    a = (
        a.selectExpr("*", f"explode(sequence({_BAND} - 1, {_BAND} + 1)) AS band")
        .selectExpr("*", _CELLS)
        .selectExpr("lon", "lat", "band", f"explode({around}) AS cell")
    )
    b = (
        b.selectExpr("*", f"{_BAND} AS band")
        .selectExpr("*", _CELLS)
        .selectExpr("lon AS lon2", "lat AS lat2", "band", f"{_CELL} AS cell")
    )
    # Little data but much arithmetic: spread it over all cores, whatever its size in bytes; a full cell in pieces.
    a = a.repartition(a.sparkSession.sparkContext.defaultParallelism, "band", "cell")
    pairs = split_join(a, b, ["band", "cell"]).filter(f"abs(lat - lat2) <= {BAND_DEGREES}D")
    return pairs.selectExpr("lon", "lat", "lon2", "lat2", f"{_KM} AS distance").filter(_IS_NEAR)


def near_sites(route_sites: DataFrame, bus_sites: DataFrame) -> DataFrame:
    """Pairs of a stop and a bus stop that are near each other or share their name, without copies.

    Two equi-joins whose results cannot overlap, instead of one product of both dictionaries. A grid cell or a name held
    by very many stops is dealt over several tasks (`split_join`).
    """
    left = route_sites.select(*SITES).distinct()
    right = bus_sites.selectExpr(*[f"{c} AS {c}2" for c in SITES]).distinct()
    columns = [*SITES, *[f"{c}2" for c in SITES], "distance"]
    points = _near_points(route_sites, bus_sites)
    near = left.join(points, ["lon", "lat"]).join(right, ["lon2", "lat2"])
    named = (
        split_join(left.withColumn("_name", F.col("site_name")), right.withColumn("_name", F.col("site_name2")), ["_name"])
        .drop("_name")
        .selectExpr("*", f"{_KM} AS distance")
        .filter(f"NOT {_IS_NEAR}")
    )
    return near.select(*columns).unionByName(named.select(*columns))
