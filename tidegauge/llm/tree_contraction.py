"""Subtree totals of large trees by parallel contraction.

Rounds alternate between two steps on the nodes still alive. Compress takes out every node with a single child:
pointers along a chain are doubled until they reach its end, which is then hung below what the chain hung from. Rake
takes out all leaves and adds their totals to their parents. After a compress every inner node has two children
or more, so each rake takes more than half of the nodes; chains take as many joins as the logarithm of their length.
Going back through the rounds, each compressed node gets the total of its chain's end and what lay between.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import written

#: Nodes of a chain that meet the total of its end in one task at most.
BLOCK = 100_000


def _chains(single: DataFrame, values: list[str]) -> DataFrame:
    """Each node of `single` (id, next, values) with its chain's end: id, via, hops, and the values summed over the hops."""
    ids = single.select(F.col("id").alias("next"), F.lit(True).alias("open"))
    now = single.join(ids, "next", "left").select("id", "next", *values, F.lit(1).cast("long").alias("hops"), F.coalesce("open", F.lit(False)).alias("open"))
    now = written(now, "chains")
    while not now.where("open").isEmpty():
        far = now.select(F.col("id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in ["next", "open", "hops", *values]])
        sums = [(F.col(c) + F.col(f"_{c}")).alias(c) for c in [*values, "hops"]]
        longer = now.where("open").join(far, F.col("next") == F.col("_id")).select("id", F.col("_next").alias("next"), *sums, F.col("_open").alias("open"))
        now = written(longer.unionByName(now.where("not open")), "chains")
    return now.select("id", F.col("next").alias("via"), "hops", *values)


def subtree_totals(nodes: DataFrame, values: list[str], block: int = BLOCK) -> DataFrame:
    """(id, values) of every node, each value summed over the node's subtree, itself included.

    `nodes` has id (long, distinct), parent (null at roots) and whole numbers in `values`. Any number of trees, of any
    shape: a chain, a star and all between. Nulls in `values` count as 0. No nodes give no rows. Each round writes its
    tables to shared storage; the driver sees counts only.
    """
    edge = {v: f"edge_{v}" for v in values}
    zero = F.lit(0).cast("long")
    alive = nodes.select("id", "parent", *[F.coalesce(F.col(v), zero).cast("long").alias(v) for v in values], *[zero.alias(e) for e in edge.values()])
    raked: list[DataFrame] = []
    packed: list[tuple[DataFrame, DataFrame]] = []
    while True:
        below = alive.where("parent is not null").groupBy(F.col("parent").alias("id"))
        below = below.agg(F.count("*").alias("n"), F.min("id").alias("child"), *[F.sum(e).alias(f"below_{v}") for v, e in edge.items()])
        state = written(alive.join(below, "id", "left").withColumn("n", F.coalesce("n", zero)), "alive")
        single = F.expr("n = 1 and parent is not null")
        size = state.agg(F.count("*").alias("all"), F.count_if(single).alias("single")).first()
        if not size["all"]:
            break
        rest = state.where(~single).select("id", "parent", "n", *values, *edge.values())
        if size["single"]:
            chain = state.where(single)
            links = _chains(chain.select("id", F.col("child").alias("next"), *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values]), values)
            inner = chain.select(F.col("child").alias("id"))
            tops = chain.join(inner, "id", "left_anti").select("id", "parent", *edge.values()).join(links, "id")
            moved = tops.select(
                F.col("via").alias("id"), F.col("parent").alias("new_parent"), "hops", *[(F.col(e) + F.col(v)).alias(f"new_{e}") for v, e in edge.items()]
            )
            moved = written(moved, "moved")
            packed.append((links, moved.select(F.col("id").alias("via"), F.col("hops").alias("length"))))
            changed = [F.coalesce(f"new_{e}", e).alias(e) for e in edge.values()]
            rest = rest.join(moved.drop("hops"), "id", "left").select("id", F.coalesce("new_parent", "parent").alias("parent"), "n", *values, *changed)
            rest = written(rest, "rest")
        leaves = rest.where("n = 0")
        raked.append(leaves.select("id", *values))
        given = leaves.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(*[F.sum(F.col(v) + F.col(e)).alias(f"given_{v}") for v, e in edge.items()])
        sums = [(F.col(v) + F.coalesce(f"given_{v}", zero)).alias(v) for v in values]
        alive = rest.where("n > 0").join(given, "id", "left").select("id", "parent", *sums, *edge.values())
    if not raked:
        return alive.select("id", *values)
    known = reduce(DataFrame.union, raked)
    for links, ends in reversed(packed):
        # A long chain's nodes all ask for one total: it is laid out once for each block of them.
        totals = known.join(ends, known["id"] == ends["via"]).select("via", "length", *[F.col(v).alias(f"end_{v}") for v in values])
        parts = F.explode(F.sequence(zero, F.floor((F.col("length") - 1) / block))).alias("part")
        totals = totals.select("via", parts, *[f"end_{v}" for v in values])
        mine = links.withColumn("part", F.floor((F.col("hops") - 1) / block))
        back = mine.join(totals, ["via", "part"]).select("id", *[(F.col(v) + F.col(f"end_{v}")).alias(v) for v in values])
        known = known.union(written(back, "expanded"))
    return known
