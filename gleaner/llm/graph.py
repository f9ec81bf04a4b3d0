"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import settle


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs in, (node, label) out for every node that has an edge to another; label is the smallest node reachable.

    Each round links the neighbours of a node to the smallest of them, first upwards, then downwards; rounds grow with the
    logarithm of the longest path. Neighbours are never gathered: a node's minimum is an aggregate joined back to its edges.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = settle(e, "edges")
    before = None
    while (now := _mark(e)) != before and now[0]:
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = settle(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        down = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = settle(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
