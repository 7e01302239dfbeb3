"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import gathered, stored


def components(edges: DataFrame, at_most: int | None = None) -> DataFrame:
    """The smallest node each node is connected with, for edges ``a``, ``b`` (long, not null).

    Alternating stars: every node's greater neighbours are tied to its smallest neighbour, then
    every node's smaller ones are, until nothing changes. No step gathers a neighbourhood: the smallest
    neighbour is an aggregate, and a join (which Spark splits where a node has very many edges) ties the others to it.
    Each round is a table in the shared folder, never of more edges than the one before, and laid out for its size; ``at_most`` bounds
    the edges of the first. Returns node, root; nodes without an edge to another are absent.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    tied = stored(pairs.distinct() if at_most is None else gathered(pairs.distinct(), at_most), "components")
    before = _mark(tied)
    while before[0]:
        both = tied.union(tied.select(F.col("v").alias("u"), F.col("u").alias("v")))
        small = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = least.select("u", F.col("m").alias("v"))
        tied = stored(gathered(kept.union(moved).distinct(), before[0]), "components")
        after = _mark(tied)
        if after == before:
            break
        before = after
    leaves = tied.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return gathered(leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct()), 2 * before[0])


def _mark(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
