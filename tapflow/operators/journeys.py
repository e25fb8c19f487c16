"""Legs merged into journeys of one card holder.

A leg joins the running journey while it is boarded at most an hour after the journey's *first*
boarding and at another stop than that; else it heads a new journey. Membership thus depends on the
head, not on the leg before: no window function expresses it.

Ordinary person-days (at most `HOT_ROWS` legs) are folded with `aggregate` over their sorted legs.
For hot keys the heads are found without walking the legs one by one: every leg knows which leg
would head the next journey if it were a head itself, and these pointers are followed from the first
leg in doubling steps, so a key of n journeys takes log2(n) joins on evenly spread positions.
"""

from pyspark.sql import DataFrame, Window, functions as F

from tapflow.operators.ordered import SLICE, running, same_key, slices, split_hot
from tapflow.operators.sizing import cut_lineage
from tapflow.operators.transfers import TRANSFER_MS
from tapflow.schemas import LEG_ORDER, LEGS, PERSON_DAY

PLACE = ["route_id", "route", "site_id", "site", "site_name", "lon", "lat"]
ON = ["on_ms", *[f"on_{c}" for c in PLACE]]
OFF = ["off_ms", *[f"off_{c}" for c in PLACE]]
FARES = ["fare_due", "fare_paid"]
JOURNEYS = [*PERSON_DAY, "card", *ON, *OFF, *FARES]

HEAD_AND_LAST, ALL_LEGS = "head_and_last", "all_legs"


def journeys(legs: DataFrame, fare: str = HEAD_AND_LAST, hot: DataFrame | None = None) -> DataFrame:
    """One row per journey: origin of its head, destination of its last leg.

    `fare` is what a journey of three or more legs costs: head plus last leg, or `all_legs`.
    """
    if fare not in (HEAD_AND_LAST, ALL_LEGS):
        raise ValueError(f"unknown fare rule {fare!r}")
    cold, busy = split_hot(legs.select(*LEGS), PERSON_DAY, hot)
    result = _folded(cold, fare)
    return result if busy is None else result.unionByName(_linked(busy, fare))


def _fare(column: str, head: str, last: str, legs: str, total: str, fare: str) -> str:
    value = total if fare == ALL_LEGS else f"IF({legs} > 1, {head} + {last}, {head})"
    return f"cast({value} AS bigint) AS {column}"


# Ordinary keys --------------------------------------------------------------------------------

# Array positions of the legs that head a journey, from one pass over (time, stop) of the legs.
_JOINS = f"(leg.on_ms - acc.on_ms <= {TRANSFER_MS} AND NOT (leg.on_site_id <=> acc.on_site_id))"
_HEADS = f"""aggregate(
    transform(legs, (leg, i) -> struct(i, leg.on_ms AS on_ms, leg.on_site_id AS on_site_id)),
    struct(cast(array() AS array<int>) AS heads, legs[0].on_ms AS on_ms,
           legs[0].on_site_id AS on_site_id),
    (acc, leg) -> IF(
        leg.i > 0 AND {_JOINS},
        acc,
        struct(array_append(acc.heads, leg.i) AS heads, leg.on_ms AS on_ms,
               leg.on_site_id AS on_site_id)
    )
).heads"""


def _folded(legs: DataFrame, fare: str) -> DataFrame:
    columns = [*LEG_ORDER, *[c for c in LEGS if c not in {*LEG_ORDER, *PERSON_DAY}]]
    days = legs.groupBy(*PERSON_DAY).agg(
        F.expr(f"sort_array(collect_list(struct({', '.join(columns)}))) AS legs")
    )
    spans = """inline(transform(heads, (h, i) -> struct(
        h AS head, coalesce(get(heads, i + 1), size(legs)) AS tail)))"""
    rows = days.selectExpr("*", f"{_HEADS} AS heads").selectExpr(*PERSON_DAY, "legs", spans)
    parts = rows.selectExpr(
        *PERSON_DAY, "legs[head] AS head", "legs[tail - 1] AS last", "tail - head AS size",
        "slice(legs, head + 1, tail - head) AS legs",
    )
    total = "aggregate(legs.{}, 0L, (acc, x) -> acc + coalesce(x, 0))"
    return parts.selectExpr(
        *PERSON_DAY,
        "head.card",
        *[f"head.{c}" for c in ON],
        *[f"last.{c}" for c in OFF],
        *[_fare(c, f"head.{c}", f"last.{c}", "size", total.format(c), fare) for c in FARES],
    )


# Hot keys -------------------------------------------------------------------------------------


def _linked(legs: DataFrame, fare: str) -> DataFrame:
    one = {"pos": F.lit(1).cast("bigint")}
    placed = cut_lineage(running(slices(legs, PERSON_DAY, LEG_ORDER), PERSON_DAY, LEG_ORDER, one))
    heads = _heads(placed).withColumn("is_head", F.lit(True))
    marked = same_key(placed, heads, [*PERSON_DAY, "pos"], "left")
    head_pos = {"head_pos": F.when(F.col("is_head"), F.col("pos"))}
    member = running(slices(marked, PERSON_DAY, ["pos"]), PERSON_DAY, ["pos"], maxima=head_pos)
    # Both aggregates combine map-side: a journey may have any number of legs.
    merged = member.groupBy(*PERSON_DAY, "head_pos").agg(
        F.expr(f"min(struct(pos, {', '.join(['card', *ON, *FARES])})) AS head"),
        F.expr(f"max(struct(pos, {', '.join([*OFF, *FARES])})) AS last"),
        F.expr("count(*) AS size"),
        *[F.expr(f"sum(coalesce({c}, 0)) AS total_{c}") for c in FARES],
    )
    return merged.selectExpr(
        *PERSON_DAY,
        "head.card",
        *[f"head.{c}" for c in ON],
        *[f"last.{c}" for c in OFF],
        *[_fare(c, f"head.{c}", f"last.{c}", "size", f"total_{c}", fare) for c in FARES],
    )


def _next_heads(placed: DataFrame) -> DataFrame:
    """(day, person, pos, next): the leg that would head the next journey if `pos` headed one."""
    narrow = placed.select(*PERSON_DAY, "pos", "on_ms", "on_site_id")
    same_stop = _next_at_stop(narrow)
    # The first leg later than on_ms + TRANSFER_MS is the one after all legs up to that time.
    legs = narrow.select(*PERSON_DAY, F.col("on_ms").alias("at"), F.lit(0).alias("probe"), "pos")
    probes = narrow.select(
        *PERSON_DAY, (F.col("on_ms") + TRANSFER_MS).alias("at"), F.lit(1).alias("probe"), "pos"
    )
    order = ["at", "probe", "pos"]
    counted = running(
        slices(legs.unionByName(probes), PERSON_DAY, order), PERSON_DAY, order,
        sums={"legs_until": F.when(F.col("probe") == 0, 1).otherwise(0).cast("bigint")},
    ).filter(F.col("probe") == 1)
    by_time = counted.select(*PERSON_DAY, "pos", (F.col("legs_until") + 1).alias("by_time"))
    return same_key(by_time, same_stop, [*PERSON_DAY, "pos"]).select(
        *PERSON_DAY, "pos", F.least("by_time", "by_stop").alias("next")
    )


def _next_at_stop(narrow: DataFrame) -> DataFrame:
    """Position of the next boarding at the same stop, by slices: one stop may hold most legs."""
    keys = [*PERSON_DAY, "on_site_id"]
    cut = slices(narrow, keys, ["pos"])
    inner = Window.partitionBy(*keys, SLICE).orderBy("pos")
    outer = Window.partitionBy(*keys).orderBy(SLICE)
    firsts = cut.groupBy(*keys, SLICE).agg(F.min("pos").alias("first"))
    firsts = firsts.withColumn("next_first", F.lead("first").over(outer)).drop("first")
    rows = cut.withColumn("here", F.lead("pos").over(inner))
    return same_key(rows, firsts, [*keys, SLICE]).select(
        *PERSON_DAY, "pos", F.coalesce("here", "next_first").alias("by_stop")
    )


def _heads(placed: DataFrame) -> DataFrame:
    """Positions of all journey heads, following `_next_heads` from position 1 in doubling steps."""
    key = [*PERSON_DAY, "pos"]
    jump = cut_lineage(_next_heads(placed))
    heads = placed.filter(F.col("pos") == 1).select(*key)
    while True:
        reached = same_key(heads, jump, key).select(*PERSON_DAY, F.col("next").alias("pos"))
        # A pointer past the last leg leads nowhere.
        reached = cut_lineage(same_key(reached, placed.select(*key), key, "left_semi"))
        if reached.isEmpty():
            return heads
        heads = cut_lineage(heads.unionByName(reached))
        hop = jump.withColumnRenamed("next", "after").withColumnRenamed("pos", "next")
        jump = cut_lineage(
            same_key(jump, hop, [*PERSON_DAY, "next"]).select(
                *PERSON_DAY, "pos", F.col("after").alias("next")
            )
        )
