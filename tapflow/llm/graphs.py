"""Connected components of a graph of any size, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from tapflow.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """Of every node with an edge (columns a, b): node, component (its smallest node).

    Each round hangs the neighbours of a node below its smallest neighbour, which is a minimum
    per node (pre-aggregated, however many neighbours) and a join; rounds end when nothing moves. A loop (a = b) and
    a null end count as no edge; repeated edges count once.
    """
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _sign(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(large.where("a != b").distinct())
        least = stored(edges.groupBy("a").agg(F.min("b").alias("m")))
        small = edges.join(least, "a").select(F.explode(F.array(
            F.struct(F.greatest("b", "m").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")),
        )).alias("e")).select("e.*")
        edges = stored(small.where("a != b").distinct())
        after = _sign(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.concat("a", "b")))).first())
