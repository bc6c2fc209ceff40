"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import fingerprint, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its neighbourhood to its larger neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its smaller neighbours to the others of them and to itself."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .where("a != b")
        .distinct()
    )


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    Nodes may be of any ordered type. Null ends, loops and repeated edges are ignored. Each round
    is two joins on keys (adaptive execution splits hubs) and writes its edges to shared storage;
    the number of rounds grows with the logarithm of the longest path. The driver sees a count and a
    hash a round.
    """
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct()
    now = written(now, "edges")
    mark = fingerprint(now)
    while mark[0]:
        after = written(_small_star(_large_star(now)), "edges")
        new = fingerprint(after)
        now, done, mark = after, new == mark, new
        if done:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
