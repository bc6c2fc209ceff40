"""Three detectors over the 19 rolling features, voting on every request."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.iforest import IsolationForest, fit_iforest
from tidegauge.operators.ml import attack_probability, persisted, scaling_stages
from tidegauge.operators.rules import alert_item
from tidegauge.schema import ML_FEATURES, ModelConfig

CFG = ModelConfig()
KEYS = ["event_id", "source_ip"]
Z = [f"z{i}" for i in range(len(ML_FEATURES))]


def _with_z(scaled: DataFrame) -> DataFrame:
    values = vector_to_array("features")
    return scaled.select("*", *[values[i].alias(z) for i, z in enumerate(Z)])


def with_distance(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add `cluster` and the distance to its centre in scaled space.

    The centres (k rows) become an array literal: the distance stays a JVM expression.
    """
    centres = model.stages[-1].clusterCenters()
    table = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in centres])
    own = F.element_at(table, F.col("cluster") + 1)
    squares = F.zip_with(vector_to_array("features"), own, lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    return model.transform(features).withColumn("distance", distance)


def fit_outlier_kmeans(features: DataFrame, cfg: ModelConfig = CFG) -> PipelineModel:
    stage = KMeans(featuresCol="features", predictionCol="cluster", k=cfg.outlier_k, maxIter=cfg.max_iter, seed=cfg.seed)
    with persisted(features) as kept:
        return Pipeline(stages=[*scaling_stages(ML_FEATURES), stage]).fit(kept)


def kmeans_outliers(model: PipelineModel, features: DataFrame, threshold: float = CFG.outlier_distance) -> DataFrame:
    """Requests farther than `threshold` from their cluster's centre."""
    return (
        with_distance(model, features)
        .filter(F.col("distance") > threshold)
        .select("event_id", "source_ip", "event_timestamp", "cluster", "distance",
                F.least(F.lit(100.0), F.col("distance") * 20).alias("confidence"))
    )


@dataclass
class Ensemble:
    """The fitted detectors; `classifier` is None when there were too few rows of a class to learn from."""

    clusters: PipelineModel
    forest: IsolationForest
    classifier: RandomForestClassifier | None

    def save(self, spark: SparkSession, path: str) -> None:
        self.clusters.write().overwrite().save(f"{path}/clusters")
        self.forest.save(spark, f"{path}/forest")
        if self.classifier is not None:
            self.classifier.write().overwrite().save(f"{path}/classifier")

    @classmethod
    def load(cls, spark: SparkSession, path: str, with_classifier: bool | None = None) -> Ensemble:
        """A saved ensemble; its classifier as asked, by default if there is one."""
        if with_classifier is None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/classifier")
            with_classifier = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        return cls(
            PipelineModel.load(f"{path}/clusters"),
            IsolationForest.load(spark, f"{path}/forest"),
            RandomForestClassificationModel.load(f"{path}/classifier") if with_classifier else None,
        )


def training_check(labelled: DataFrame, cfg: ModelConfig = CFG, label: str = "is_attack") -> DataFrame:
    """One row: rows, attacks, others, and whether they do for a fit at all (`enough_rows`) and for the classifier.

    A fit needs `min_rows` rows; the classifier more than `min_positives` attacks and some rows that are none.
    """
    counts = labelled.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("attacks"), F.count_if(F.col(label) == 0).alias("others")
    )
    return counts.withColumns(
        {
            "enough_rows": F.col("rows") >= cfg.min_rows,
            "enough_attacks": (F.col("attacks") > cfg.min_positives) & (F.col("others") > 0),
        }
    )


def fit_ensemble(labelled: DataFrame, cfg: ModelConfig = CFG, label: str = "is_attack") -> Ensemble:
    """Fit on rolling features with a pseudo-label column.

    The clusters and the isolation forest need no labels; the classifier is fitted if training_check allows it.
    """
    with persisted(labelled) as kept:
        clusters = fit_outlier_kmeans(kept, cfg)
        scaled = _with_z(clusters.transform(kept))
        forest = fit_iforest(scaled, Z, KEYS, trees=cfg.trees, contamination=cfg.contamination, seed=cfg.seed)
        classifier = None
        if training_check(kept, cfg, label).first().enough_attacks:
            classifier = RandomForestClassifier(
                featuresCol="features", labelCol=label, predictionCol="vote", numTrees=cfg.trees,
                maxDepth=cfg.depth, maxBins=cfg.bins, seed=cfg.seed,
            ).fit(scaled)
        return Ensemble(clusters, forest, classifier)


def train_ensemble(labelled: DataFrame, cfg: ModelConfig = CFG, label: str = "is_attack") -> Ensemble | None:
    """`fit_ensemble` if there are at least `min_rows` rows, else None."""
    with persisted(labelled) as kept:
        return fit_ensemble(kept, cfg, label) if training_check(kept, cfg, label).first().enough_rows else None


def score_ensemble(model: Ensemble, features: DataFrame) -> DataFrame:
    """Rolling features with `cluster`, `distance`, `decision`, `vote` and `attack_probability`.

    Without a classifier nobody was asked: vote and probability are null.
    """
    scored = model.forest.score(_with_z(with_distance(model.clusters, features)))
    if model.classifier is None:
        scored = scored.withColumns({c: F.lit(None).cast("double") for c in ("vote", "attack_probability")})
    else:
        scored = model.classifier.transform(scored).withColumn("attack_probability", attack_probability())
    return scored.drop("raw_features", "features", "rawPrediction", "probability", *Z)


def ensemble_alerts(scored: DataFrame, threshold: float = CFG.outlier_distance) -> DataFrame:
    """Requests flagged by at least one detector, with mean confidence and number of votes.

    Types, severities, message texts and confidence scales are fixed values.
    """
    ip = F.col("source_ip")
    percent: Column = F.col("attack_probability") * 100
    votes = [
        (
            F.col("distance") > threshold,
            alert_item(
                "kmeans_anomaly",
                "HIGH",
                F.format_string("IP %s behavior deviates from cluster %d (distance: %.2f)", ip, F.col("cluster"), F.col("distance")),
                F.least(F.lit(100.0), F.col("distance") * 20),
            ),
        ),
        (
            F.col("decision") < 0,
            alert_item(
                "isolation_forest_anomaly",
                "MEDIUM",
                F.format_string("IP %s flagged as anomaly (score: %.3f)", ip, F.col("decision")),
                F.least(F.lit(100.0), F.abs("decision") * 50),
            ),
        ),
        (
            F.col("vote") == 1,
            alert_item(
                "random_forest_classification",
                F.when(percent > 80, "HIGH").otherwise("MEDIUM"),
                F.format_string("IP %s classified as attack (confidence: %.1f%%)", ip, percent),
                percent,
            ),
        ),
    ]
    fired = F.array_compact(F.array(*[F.when(condition, item) for condition, item in votes]))
    total = F.aggregate("alerts", F.lit(0.0), lambda t, a: t + a["confidence"])
    return (
        scored.withColumn("alerts", fired)
        .filter(F.size("alerts") > 0)
        .withColumn("models_used", F.size("alerts"))
        .withColumn("confidence", total / F.col("models_used"))
    )
