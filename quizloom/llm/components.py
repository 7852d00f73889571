"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.session import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of long ids to (node, root): root is the smallest id that node reaches.

    Only nodes that have a link appear. No node's neighbours are gathered in one task: minima
    are partial aggregates, and they come back by a sort-merge join that adaptive execution can split:
    minima are as many as nodes, so none of them is broadcast from the driver.
    A table without links gives no rows; links from a node to itself are dropped.
    """
    edges = cut(edges.where("u <> v").selectExpr("greatest(u, v) u", "least(u, v) v").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low).distinct()
        edges = cut(small, "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
