"""Isolation forest as Spark jobs (Liu, Ting and Zhou, "Isolation Forest", ICDM 2008).

Trees grow in parallel from samples of fixed size, so a forest has at most
trees * (2 * sample - 1) nodes and can be shipped to every task whatever the table's size.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.operators.ml import persisted

SCORE_BINS = 1 << 20
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    many = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def grow_tree(tree: int, points: np.ndarray, seed: int) -> pd.DataFrame:
    """Split at random until points are alone, alike, or at the depth limit."""
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list] = []
    pending = [(points, 0, None, None)]
    while pending:
        part, depth, parent, side = pending.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent][side] = at
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(usable) == 0:
            nodes.append([tree, at, -1, 0.0, -1, -1, depth + float(average_path(len(part)))])
            continue
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        below = part[:, feature] <= threshold
        nodes.append([tree, at, feature, threshold, -1, -1, 0.0])
        pending.append((part[~below], depth + 1, at, 5))
        pending.append((part[below], depth + 1, at, 4))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])


def flatten(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """The forest as arrays; a leaf leads to itself, so that every walk may take the same steps."""
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    at = np.arange(len(nodes))
    roots = np.flatnonzero(nodes["node"] == 0)
    root_of = roots[np.searchsorted(roots, at, side="right") - 1]
    leaf = (nodes["feature"] < 0).to_numpy()
    children = [np.where(leaf, at, nodes[side].to_numpy() + root_of) for side in ("left", "right")]
    return {
        "roots": roots,
        "feature": np.where(leaf, 0, nodes["feature"].to_numpy()),
        "threshold": nodes["threshold"].to_numpy(),
        "children": np.stack(children, axis=1).ravel(),
        "path": nodes["path"].to_numpy(),
    }


def mean_paths(points: np.ndarray, forest: dict[str, np.ndarray], steps: int) -> np.ndarray:
    """Mean path length of every point; all points walk down a tree together."""
    total = np.zeros(len(points))
    rows = np.arange(len(points))
    for root in forest["roots"]:
        at = np.full(len(points), root)
        for _ in range(steps):
            above = points[rows, forest["feature"][at]] > forest["threshold"][at]
            at = forest["children"][2 * at + above]
        total += forest["path"][at]
    return total / len(forest["roots"])


def score_by_nodes(features: DataFrame, columns: list[str], nodes: pd.DataFrame, sample: int) -> DataFrame:
    """Add `score` as IsolationForest.score does, without Python workers.

    The nodes become a constant, an array of trees, which the forest's settings bound; each row walks down all
    trees in expressions.
    """
    ordered = nodes.sort_values(["tree", "node"])
    names = ["feature", "threshold", "left", "right", "path"]
    trees = [[dict(zip(names, n, strict=True)) for n in part[names].astype(object).itertuples(index=False)] for _, part in ordered.groupby("tree")]
    schema = "array<array<struct<feature: int, threshold: double, left: int, right: int, path: double>>>"
    forest = F.from_json(F.lit(json.dumps(trees)), schema)  # folded into a constant when the query is planned
    steps = F.sequence(F.lit(1), F.lit(int(np.ceil(np.log2(max(sample, 2))))))
    point = F.array(*[F.col(c).cast("double") for c in columns])

    def walk(point: Column) -> Column:
        def below(tree: Column, at: Column) -> Column:
            here = tree[at]
            return F.when(here["feature"] < 0, at).when(point[here["feature"]] <= here["threshold"], here["left"]).otherwise(here["right"])

        def path(tree: Column) -> Column:
            return tree[F.aggregate(steps, F.lit(0), lambda at, _: below(tree, at))]["path"]

        return F.aggregate(forest, F.lit(0.0), lambda total, tree: total + path(tree))

    mean = F.transform(F.array(point), walk)[0] / len(trees)
    return features.withColumn("score", F.pow(F.lit(2.0), -mean / F.lit(float(average_path(sample)))))


@dataclass
class IsolationForest:
    """A grown forest; `nodes` is bounded by the forest's settings, not by the data."""

    nodes: pd.DataFrame
    columns: list[str]
    sample: int
    offset: float | None = None

    def score(self, features: DataFrame) -> DataFrame:
        """Add `score` in (0, 1], higher for rows that are isolated sooner, and `decision` once an offset is set."""
        scale = float(average_path(self.sample))
        steps = int(np.ceil(np.log2(max(self.sample, 2))))
        shared = features.sparkSession.sparkContext.broadcast(flatten(self.nodes))

        @F.pandas_udf("double")
        def isolation_score(*values: pd.Series) -> pd.Series:
            points = np.column_stack([v.to_numpy(dtype=float) for v in values])
            return pd.Series(np.power(2.0, -mean_paths(points, shared.value, steps) / scale))

        scored = features.withColumn("score", isolation_score(*[F.col(c).cast("double") for c in self.columns]))
        if self.offset is None:
            return scored
        return scored.withColumn("decision", F.lit(self.offset) - F.col("score"))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        settings = json.dumps({"columns": self.columns, "sample": self.sample, "offset": self.offset})
        spark.range(1).select(F.lit(settings).alias("value")).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        settings = json.loads(spark.read.text(f"{path}/settings").first().value)
        return cls(spark.read.parquet(f"{path}/nodes").toPandas(), **settings)


def tree_samples(features: DataFrame, keys: list[str], rows: int, trees: int, sample: int, seed: int) -> DataFrame:
    """About `sample` of the `rows` rows for each tree, chosen by hash so that a retried task chooses the same.

    Every row draws for every tree, at any number of rows: the expected number of copies is `trees` x three
    times `sample`, and the surplus is cut, so a tree's group stays small.
    """
    grain = 1 << 40
    draw = lambda *parts: F.pmod(F.xxhash64(F.lit(seed), *parts, *keys), F.lit(grain))
    limit = int(min(1.0, 3 * sample / max(rows, 1)) * grain)
    # A row meets few trees or none: the list of its trees is made before it is copied.
    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < limit)
    offered = features.withColumn("tree", F.explode(mine))
    order = Window.partitionBy("tree").orderBy(draw(F.col("tree")), *keys)
    return offered.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample).drop("_n")


def score_offset(scored: DataFrame, share: float) -> float:
    """Score that `share` of the rows do not exceed, up to one of SCORE_BINS equal bins of (0, 1].

    Binning makes one pass of the scoring function do; at most SCORE_BINS + 1 rows are ranked.
    """
    bins = scored.groupBy(F.floor(F.col("score") * SCORE_BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max("score").alias("top")
    )
    upto = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = bins.select("top", upto.alias("upto"), F.sum("n").over(Window.partitionBy()).alias("total"))
    return ranked.filter(F.col("upto") >= F.col("total") * share).agg(F.min("top")).first()[0]


def fit_iforest(
    features: DataFrame,
    columns: list[str],
    keys: list[str],
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.1,
    seed: int = 42,
) -> IsolationForest:
    """Grow the forest and set the offset so that `contamination` of the rows score above it."""
    needed = features.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    with persisted(needed) as needed:
        return _grow(needed, list(columns), keys, trees, sample, contamination, seed)


def _grow(needed: DataFrame, columns, keys, trees, sample, contamination, seed) -> IsolationForest:
    rows = needed.count()
    samples = tree_samples(needed, keys, rows, trees, sample, seed)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(keys)
        return grow_tree(int(ordered["tree"].iloc[0]), ordered[columns].to_numpy(dtype=float), seed)

    nodes = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    forest = IsolationForest(nodes, columns, min(sample, rows))
    forest.offset = score_offset(forest.score(needed), 1 - contamination)
    return forest
