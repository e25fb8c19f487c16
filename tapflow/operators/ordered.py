"""Looking at neighbouring rows inside a key without trusting keys to be small.

A window over (service_date, person) sorts one person's day inside one task. That is right for
people, and wrong for a shared or default card number that collects a large part of all rows. So
the few keys with more than `HOT_ROWS` rows are found first (`hot_keys`, one pre-aggregated count),
and take another way: their rows are *range*-partitioned by key and order, which cuts a long key
into consecutive slices, and each slice hands its first and last row to its neighbours (`sliced`
functions). Both ways give the same rows; the rest of the engine does not see the difference.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.operators.sizing import broadcast_if_small, cut_lineage

# A person or vehicle has tens of rows a day; a key above this is an artefact such as a shared card.
HOT_ROWS = 10_000
SLICE, MARK = "_slice", "_hot"


def hot_keys(frames: list[DataFrame], keys: list[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than `limit` rows in `frames` together, or None if there are none.

    There are at most rows / limit such keys. The count combines map-side before it shuffles.
    """
    rows = reduce(DataFrame.unionByName, [f.select(*keys) for f in frames])
    hot = rows.groupBy(*keys).count().filter(f"count > {limit}").select(*keys).persist()
    if hot.isEmpty():
        hot.unpersist()
        return None
    return broadcast_if_small(hot)


def split_hot(
    df: DataFrame, keys: list[str], hot: DataFrame | None
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None).

    With hot keys, all rows are written out once with a mark: the ordinary ones are read from there, and those of hot
    keys twice (for their range bounds, and to be cut), without making the rows again for each. `hot` has a key once.
    """
    if hot is None:
        return df, None
    marked = cut_lineage(same_key(df, hot.withColumn(MARK, F.lit(True)), keys, "left"))
    return marked.filter(f"{MARK} IS NULL").drop(MARK), marked.filter(f"{MARK} IS NOT NULL").drop(MARK)


def same_key(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which missing keys equal each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def slices(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """`df` cut into consecutive slices of (keys, order), the slice number fixed in storage.

    The slice number depends on sampled range bounds, so it is written out before it is used twice.
    """
    ranged = df.repartitionByRange(*keys, *order)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: list[str] | None = None,
    following: list[str] | None = None,
    opening: list[str] | None = None,
    hot: DataFrame | None = None,
    collapse_copies: bool = False,
) -> DataFrame:
    """Adds structs of columns of other rows of the same key, in `order`:

    `previous` (NULL on the first row), `following` (NULL on the last row) and `opening` (the first
    row). `collapse_copies` drops exact copies among hot keys, where the caller's result allows it.
    """
    wanted = {"previous": previous, "following": following, "opening": opening}
    wanted = {name: cols for name, cols in wanted.items() if cols}
    cold, busy = split_hot(df, keys, hot)
    result = _by_window(cold, keys, order, wanted)
    if busy is None:
        return result
    if collapse_copies:
        busy = busy.dropDuplicates()
    return result.unionByName(_by_slices(slices(busy, keys, order), keys, order, wanted))


def _struct(columns: list[str]) -> Column:
    return F.expr(f"struct({', '.join(columns)})")


def _looks(window, wanted: dict[str, list[str]]) -> dict[str, Column]:
    over = {"previous": F.lag, "following": F.lead, "opening": F.first}
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        name: over[name](_struct(cols)).over(so_far if name == "opening" else window)
        for name, cols in wanted.items()
    }


def _by_window(df: DataFrame, keys, order, wanted) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[c.alias(n) for n, c in _looks(window, wanted).items()])


def _by_slices(sliced: DataFrame, keys, order, wanted) -> DataFrame:
    inner = Window.partitionBy(*keys, SLICE).orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(SLICE)
    first_of_key = outer.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = {
        "previous": lambda: F.lag(F.col("_last")).over(outer),
        "following": lambda: F.lead(F.col("_first")).over(outer),
        "opening": lambda: F.first(F.col("_first")).over(first_of_key),
    }
    edge_cols = list(dict.fromkeys([*order, *[c for cols in wanted.values() for c in cols]]))
    # One row per slice and key: as many as there are slices, plus one per hot key.
    edges = (
        sliced.groupBy(*keys, SLICE)
        .agg(
            F.min(_struct(edge_cols)).alias("_first"), F.max(_struct(edge_cols)).alias("_last")
        )
        .select(*keys, SLICE, *[carried[name]().alias(f"_edge_{name}") for name in wanted])
    )
    rows = sliced.select("*", *[c.alias(n) for n, c in _looks(inner, wanted).items()])
    joined = same_key(rows, edges, [*keys, SLICE])
    out = []
    for name, cols in wanted.items():
        edge = F.col(f"_edge_{name}")
        edge = F.when(edge.isNotNull(), F.struct(*[edge[c].alias(c) for c in cols]))
        here = F.col(name)
        out.append((edge if name == "opening" else F.coalesce(here, edge)).alias(name))
    keep = [c for c in sliced.columns if c != SLICE]
    return joined.select(*keep, *out)


def running(
    sliced: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
) -> DataFrame:
    """Running sums and maxima over the whole key for rows cut by `slices`; the slice is dropped."""
    sums, maxima = sums or {}, maxima or {}
    inner = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*keys, SLICE).agg(
        *[F.sum(c).alias(f"_edge_{n}") for n, c in sums.items()],
        *[F.max(c).alias(f"_edge_{n}") for n, c in maxima.items()],
    )
    totals = totals.select(
        *keys,
        SLICE,
        *[F.sum(f"_edge_{n}").over(before).alias(f"_edge_{n}") for n in sums],
        *[F.max(f"_edge_{n}").over(before).alias(f"_edge_{n}") for n in maxima],
    )
    rows = sliced.select(
        "*",
        *[F.sum(c).over(inner).alias(n) for n, c in sums.items()],
        *[F.max(c).over(inner).alias(n) for n, c in maxima.items()],
    )
    joined = same_key(rows, totals, [*keys, SLICE])
    keep = [c for c in sliced.columns if c != SLICE]
    return joined.select(
        *keep,
        *[(F.coalesce(f"_edge_{n}", F.lit(0)) + F.col(n)).alias(n) for n in sums],
        *[F.greatest(f"_edge_{n}", n).alias(n) for n in maxima],
    )
