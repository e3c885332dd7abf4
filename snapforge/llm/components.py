"""Connected components by alternating large-star and small-star rounds; edges and labels stay in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapforge.llm.common import written


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("hi <> lo").select(
        F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(lowest.select("hi", F.col("m").alias("lo")))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: root is the smallest node that can be reached; nodes without an edge to another are left out.

    Nodes are of any type that can be ordered. Edges with a null end are ignored. Every round replaces neighbours by
    the smallest one seen, in the order of log(n) squared rounds at most; a hub is one side of a join whose other
    side has one row a node, so its rows can be split.
    """
    named = edges.select(F.col(a).alias("hi"), F.col(b).alias("lo")).dropna()
    now, before = written(_ordered(named), "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if mark == before or mark[0] == 0:
            break
        before, now = mark, written(_ordered(_small_star(_ordered(_large_star(now)))), "edges")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
