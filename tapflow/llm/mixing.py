"""Mixing sources to target weights: temperature, quotas, and block permutations that meet a budget.

A source's weight is its share of all tokens to the power of an exponent, normalised. Bisection finds the smallest
exponent (the flattest mix) that keeps a limit on repetition, or reaches a target entropy. A weight times the budget is a
source's quota: so many whole epochs, and of one more epoch as much of its permutation as the rest pays for.

The permutation of an epoch is the order of a 60-bit hash of epoch and doc_id. Where the quota ends in it is found digit
by digit: sums for the 1024 values of the next ten bits say in which of them it ends, and only these
rows are looked at again. So no source, however large, is sorted or held by one task. A copy's place in its source's
epochs also gives its block in the mixed stream: every block holds all sources at about their weights.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.llm import shared

MAX_REPEATS = 1.25
BLOCK_TOKENS = 1_000_000
SEED = 17
#: Rows of the table of sources up to which it is broadcast (about 100 bytes each).
BROADCAST_SOURCES = 100_000
BITS, DIGIT = 60, 10
SECTIONS, ROUNDS = 32, 6  # 30 halvings
WORD = r"[^\\x09-\\x0D\\x20]+"


def n_tokens() -> Column:
    """Words between white space."""
    return F.expr(f"CAST(regexp_count(coalesce(CAST(text AS string), ''), '{WORD}') AS bigint)")


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _key(epoch: Column, doc_id: Column, seed: int) -> Column:
    """Place of a document in the permutation of an epoch."""
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def exponent(sums: DataFrame, budget: int, max_repeats: float | None, target_entropy: float | None) -> tuple[float, float]:
    """The smallest exponent from 0 to 1 that is allowed (1 if none is), and the sum that normalises its weights.

    Repetition is a source's quota over its tokens; entropy is in nats. The driver sees sums for each
    exponent tried, whatever the number of sources.
    """
    total, least = sums.agg(F.sum("tokens"), F.min("tokens")).first()
    share = F.col("tokens") / F.lit(float(total))

    def tried(points: list[float]) -> dict[float, tuple[float, float]]:
        powers = sums.select(share.alias("p"), F.explode(F.array(*map(F.lit, points))).alias("a"))
        z = F.pow("p", "a")
        rows = powers.groupBy("a").agg(F.sum(z).alias("z"), F.sum(z * F.log("p")).alias("s")).collect()
        return {r.a: (r.z, r.s) for r in rows}

    def allowed(a: float, z: float, s: float) -> bool:
        if target_entropy is not None:
            return math.log(z) - a * s / z <= target_entropy
        return budget / total * (least / total) ** (a - 1) / z <= max_repeats

    ends = tried([0.0, 1.0])
    for a in (0.0, 1.0):
        if a == 1 or allowed(a, *ends[a]):
            if a == 0 or not allowed(a, *ends[a]):
                return a, ends[a][0]
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / SECTIONS
        points = [low + step * j for j in range(1, SECTIONS + 1)]
        found = tried(points)
        high = next((a for a in points if allowed(a, *found[a])), high)
        low = high - step
    return high, tried([high])[high][0]


def weights(
    counted: DataFrame, budget: int | None = None, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
) -> DataFrame:
    """Per source (columns source, n_tokens given): source, tokens, weight, quota, epochs, rest.

    `budget` is in tokens, by default all there are. Sources without tokens have weight 0.
    """
    sums = shared.stored(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    some = sums.where("tokens > 0")
    total = some.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    a, z = exponent(some, budget, max_repeats, target_entropy) if total else (1.0, 1.0)
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(a)) / F.lit(z)).otherwise(0.0)
    quota = F.floor(F.lit(float(budget)) * weight)
    return sums.withColumn("weight", weight).withColumn("quota", quota).selectExpr(
        "*", "CASE WHEN tokens > 0 THEN quota DIV tokens ELSE 0 END AS epochs",
        "CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest",
    )


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan; broadcast if counted as small, else adaptive execution splits large sources."""
    small = plan.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(plan) if small else plan, "source")


def _ends(counted: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """The plan with `cut`: the first key of the last epoch that its rest doesn't pay for (2**60: it pays for all)."""
    keyed = _with_plan(counted, plan.select("source", "epochs", "rest")).select(
        "source", "n_tokens", _key(F.col("epochs"), F.col("doc_id"), seed).alias("key"), "rest"
    )
    open_ = shared.stored(keyed.groupBy("source", "key", "rest").agg(F.sum("n_tokens").alias("n")))
    order = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    shift = BITS
    while shift:
        shift -= DIGIT
        digit = F.expr(f"shiftright(key, {shift}) & {(1 << DIGIT) - 1}").alias("digit")
        sums = open_.groupBy("source", "rest", digit).agg(F.sum("n").alias("n"))  # 1024 rows for a source at most
        over = sums.withColumn("sum", F.sum("n").over(order)).where("sum > rest AND sum - n <= rest")
        over = shared.stored(over.select("source", "digit", (F.col("rest") - F.col("sum") + F.col("n")).alias("left")))
        within = _joined(open_.withColumn("digit", digit), over, ["source", "digit"])
        open_ = shared.stored(within.select("source", "key", F.col("left").alias("rest"), "n"))
    cut = open_.groupBy("source").agg(F.min("key").alias("cut"))
    return shared.stored(plan.join(cut, "source", "left").withColumn("cut", F.coalesce("cut", F.lit(1 << BITS))))


def _joined(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(F.broadcast(small) if small.count() <= BROADCAST_SOURCES else small, on)


def _drawn(docs: DataFrame, plan: DataFrame, seed: int, block_tokens: int) -> DataFrame:
    """Rows with doc_id and source, once for each copy, with epoch, block and sort_key."""
    blocks = max(1, -(-(plan.agg(F.sum("quota")).first()[0] or 0) // block_tokens))
    copies = _with_plan(docs, plan.select("source", "tokens", "quota", "epochs", "cut")).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs")))
    ).withColumn("sort_key", _key(F.col("epoch"), F.col("doc_id"), seed))
    taken = copies.where("epoch < epochs OR sort_key < cut")
    place = F.expr("(epoch + shiftright(sort_key, 30) / 1073741824D) * greatest(tokens, 1) / greatest(quota, 1)")
    block = F.least(F.lit(blocks - 1), F.floor(place * F.lit(float(blocks)))).cast("long")
    return taken.withColumn("block", block).drop("tokens", "quota", "epochs", "cut")


def draws(
    docs: DataFrame, budget: int | None = None, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
    seed: int = SEED, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per copy drawn: doc_id, source, n_tokens, epoch, block, sort_key (order within the block).

    Null sources count as the source ''. Documents without tokens cost nothing. Rows with equal ids of a source are
    drawn together or not at all; null ids count as equal.
    """
    counted = shared.stored(docs.select("doc_id", _source().alias("source"), n_tokens().alias("n_tokens")))
    plan = _ends(counted, shared.stored(weights(counted, budget, max_repeats, target_entropy)), seed)
    return _drawn(counted, plan, seed, block_tokens).select("doc_id", "source", "n_tokens", "epoch", "block", "sort_key")


def mix(docs: DataFrame, budget: int | None = None, max_repeats: float | None = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The documents, all columns, each as often as it is drawn."""
    counted = shared.stored(docs.select("doc_id", _source().alias("source"), n_tokens().alias("n_tokens")))
    plan = _ends(counted, shared.stored(weights(counted, budget, max_repeats)), seed)
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select("doc_id", _source().alias("source"), given.alias("given"))
    return _drawn(rows, plan, seed, BLOCK_TOKENS).select("given.*")
