"""Connected components of an edge table by alternating large and small stars.

Every round is two joins of the edges with the smallest neighbour of each node; nothing is gathered for a
node beyond that minimum, so a hub with any number of neighbours is an ordinary skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import few, staged


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _ordered(edges: DataFrame, one: str, other: str) -> DataFrame:
    return (
        edges.select(F.greatest(one, other).alias("hi"), F.least(one, other).alias("lo")).where("hi <> lo").distinct()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) for all nodes that have an edge to another node.

    Null ends and loops are left out; repeated edges count once. Ends when a round changes nothing;
    an error says so where that takes more than ``rounds``.
    """
    spark = edges.sparkSession
    edges = staged(_ordered(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b), "edges", few(spark))
    before = _checksum(edges)
    for _ in range(rounds):
        # An edge is two numbers; tasks of a few hundred thousand edges are small.
        files = 2 + before[0] // 250_000
        # Large star: what lies above a node is tied to the smallest node next to it.
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least", files)
        large = staged(_ordered(edges.join(least, edges["lo"] == least["u"]).select("hi", "m"), "hi", "m"), "large", files)
        # Small star: what lies below a node, and the node, are tied to the smallest of them.
        least = staged(large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m")), "least", files)
        joined = large.join(least, large["hi"] == least["u"])
        below = joined.select(F.col("lo").alias("x"), "m").unionByName(least.select(F.col("u").alias("x"), "m"))
        edges = staged(_ordered(below, "x", "m"), "edges", files)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    members = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return members.unionByName(roots)
