"""Cluster models as relations: stored centres, assignment, distance and silhouette in plain expressions.

Centres are rows (cluster, centre), so they can be kept in a table, joined with what is known of a cluster, and
applied without the model that found them. There are few of them; each row of points meets them as one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def centres_of(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(cluster, centre) of a fitted k-means pipeline, in the space of its scaled features."""
    found = model.stages[-1].clusterCenters()
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(found)], "cluster int, centre array<double>")


def centres_of_groups(points: DataFrame, columns: Sequence[str], cluster: Column) -> DataFrame:
    """(cluster, centre): the mean of each group of points."""
    means = points.groupBy(cluster.cast("int").alias("cluster")).agg(*[F.avg(c).alias(c) for c in columns])
    return means.select("cluster", F.array(*columns).alias("centre"))


def _squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)


def assign(points: DataFrame, centres: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The points with `cluster`, that of the nearest centre (ties go to the smaller number), and the `distance` to it."""
    table = centres.agg(F.sort_array(F.collect_list(F.struct("cluster", "centre")))).scalar()
    here = F.array(*[F.col(c).cast("double") for c in columns])
    apart = F.transform("_centres", lambda c: F.struct(_squared(here, c["centre"]).alias("d"), c["cluster"].alias("cluster")))
    nearest = points.withColumn("_centres", table).withColumn("_nearest", F.array_min(apart))
    return nearest.withColumns({"cluster": F.col("_nearest.cluster"), "distance": F.sqrt("_nearest.d")}).drop("_nearest", "_centres")


def outliers(assigned: DataFrame, threshold: float) -> DataFrame:
    """Points farther than `threshold` from their centre, with the confidence of the alert."""
    far = assigned.filter(F.col("distance") > threshold)
    return far.withColumn("confidence", F.least(F.lit(100.0), F.col("distance") * 20))


def silhouettes(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The points with `silhouette` by squared distance: (b - a) / max(a, b), a to the own cluster's others, b to the nearest other one.

    Mean squared distances to a cluster follow from its size, sums and sum of squares, so one aggregate of the points does
    instead of their pairs. A point alone in its cluster has 0, as all have where there is one cluster.
    """
    squares = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    moments = assigned.groupBy("cluster").agg(
        F.count("*").cast("double").alias("n"), F.array(*[F.sum(c) for c in columns]).alias("sums"), F.sum(squares).alias("squares")
    )
    table = moments.agg(F.collect_list(F.struct("cluster", "n", "sums", "squares"))).scalar()
    here = F.array(*[F.col(c).cast("double") for c in columns])

    def mean_squared(m: Column) -> Column:
        dot = F.aggregate(F.zip_with(here, m["sums"], lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
        return F.greatest(squares + m["squares"] / m["n"] - 2 * dot / m["n"], F.lit(0.0))

    means = F.transform("_moments", lambda m: F.struct(m["cluster"].alias("cluster"), m["n"].alias("n"), mean_squared(m).alias("d")))
    own = F.filter("_means", lambda m: m["cluster"] == F.col("cluster"))[0]
    other = F.array_min(F.transform(F.filter("_means", lambda m: m["cluster"] != F.col("cluster")), lambda m: m["d"]))
    found = assigned.withColumn("_moments", table).withColumn("_means", means).withColumns({"_own": own, "_b": other})
    a = F.col("_own.d") * F.col("_own.n") / (F.col("_own.n") - 1)
    value = F.when((F.col("_own.n") == 1) | F.col("_b").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("_b") - a, F.greatest(a, "_b")), F.lit(0.0)))
    return found.withColumn("silhouette", value).drop("_moments", "_means", "_own", "_b")


def silhouette_by_cluster(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(cluster, points, silhouette): the mean of each cluster; the mean of all is weighted by `points`."""
    return silhouettes(assigned, columns).groupBy("cluster").agg(F.count("*").alias("points"), F.avg("silhouette").alias("silhouette"))
