"""Connected components of a graph of long node ids, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of ``edges`` (a, b) is connected with.

    Alternates large-star and small-star steps, which halve the distances to the smallest node and end
    with every node pointing at it. Minima are found by aggregation before the shuffle and joined
    back, so a node with very many neighbours is never gathered. Each round is stored.
    """
    pairs = staged(_ordered(edges))
    known = _print(pairs)
    while known[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = _ordered(large)
        floor = down.groupBy("b").agg(F.min("a").alias("m"))
        small = down.join(floor, "b").select(F.explode(F.array(
            F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b"))
        )).alias("e")).select("e.a", "e.b")
        pairs = staged(_ordered(small))
        now = _print(pairs)
        if now == known:
            break
        known = now
    roots = pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(pairs.select(F.col("a").alias("node"), F.col("a").alias("root"))).groupBy("node").agg(
        F.min("root").alias("root")
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with the smaller node as a, without loops."""
    return (
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _print(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
