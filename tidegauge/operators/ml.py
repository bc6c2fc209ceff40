"""Clustering and classification of window features with MLlib pipelines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import ratio
from tidegauge.operators.windows import window_features_v2
from tidegauge.schema import WINDOW_V1_FEATURES, WINDOW_V2_FEATURES, ModelConfig

CFG = ModelConfig()


def scaling_stages(columns, center: bool = True) -> list:
    """Assemble `columns` (rows with a missing value are skipped) and standardise them."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=center, withStd=True),
    ]


def scale(features: DataFrame, columns=WINDOW_V2_FEATURES) -> tuple[DataFrame, PipelineModel]:
    """Features plus their z-score vector `features`, and the fitted scaler."""
    model = Pipeline(stages=scaling_stages(columns)).fit(features)
    return model.transform(features), model


def z_scores(features: DataFrame, columns=WINDOW_V2_FEATURES, keys=("source_ip", "window_start")) -> DataFrame:
    """Keys and one z-score column per feature."""
    scaled, _ = scale(features, columns)
    values = vector_to_array("features")
    return scaled.select(*keys, *[values[i].alias(f"z_{c}") for i, c in enumerate(columns)])


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` while it is read several times, unless its owner keeps it already."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def _fit(features: DataFrame, columns, stage, center: bool = True) -> PipelineModel:
    """Scaler and estimator both pass over the features: compute them once."""
    with persisted(features) as kept:
        return Pipeline(stages=[*scaling_stages(columns, center), stage]).fit(kept)


def fit_kmeans(features: DataFrame, columns=WINDOW_V1_FEATURES, k: int = CFG.kmeans_k, cfg: ModelConfig = CFG) -> PipelineModel:
    stage = KMeans(featuresCol="features", predictionCol="cluster", k=k, maxIter=cfg.max_iter, seed=cfg.seed)
    return _fit(features, columns, stage)


def fit_bisecting(features: DataFrame, columns=WINDOW_V1_FEATURES, k: int = 3, cfg: ModelConfig = CFG) -> PipelineModel:
    """Hierarchical clustering of scaled but not centred features.

    MLlib splits a cluster by nudging its centre in proportion to the centre's length; centred
    features have their first centre at the origin, where nothing would ever split.
    """
    stage = BisectingKMeans(featuresCol="features", predictionCol="cluster", k=k, maxIter=cfg.max_iter, seed=cfg.seed)
    return _fit(features, columns, stage, center=False)


def split(features: DataFrame, keys=("window_start", "source_ip"), share: int = 80, seed: int = CFG.seed):
    """(train, test) by a hash of the keys: the same rows whatever the partitioning or retries."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(100))
    return features.filter(bucket < share), features.filter(bucket >= share)


def require_two_classes(features: DataFrame, label: str, cfg: ModelConfig) -> None:
    """Tree classifiers need rows of both classes."""
    counts = features.agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    ).first()
    if counts.positives == 0 or counts.negatives == 0:
        raise ValueError(f"no examples of one class: {counts.positives} attacks, {counts.negatives} normal")


def _fit_labelled(features: DataFrame, columns, stage, label: str, cfg: ModelConfig) -> PipelineModel:
    with persisted(features) as kept:
        require_two_classes(kept, label, cfg)
        return _fit(kept, columns, stage)


def fit_random_forest(
    features: DataFrame, columns=WINDOW_V1_FEATURES, label: str = "is_attack", cfg: ModelConfig = CFG
) -> PipelineModel:
    stage = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=cfg.trees, maxDepth=cfg.depth, maxBins=cfg.bins, seed=cfg.seed
    )
    return _fit_labelled(features, columns, stage, label, cfg)


def fit_boosting(
    features: DataFrame, columns=WINDOW_V1_FEATURES, label: str = "is_attack", cfg: ModelConfig = CFG
) -> PipelineModel:
    stage = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=cfg.boost_iter, maxDepth=cfg.boost_depth, seed=cfg.seed
    )
    return _fit_labelled(features, columns, stage, label, cfg)


def attack_probability(column: str = "probability") -> Column:
    """Probability of class 1; a model that saw one class only has no such entry."""
    return F.coalesce(F.get(vector_to_array(column), F.lit(1)), F.lit(0.0))


def score(model: Model, features: DataFrame) -> DataFrame:
    """Features with the model's output columns, vectors left out."""
    scored = model.transform(features)
    if "probability" in scored.columns:
        scored = scored.withColumn("attack_probability", attack_probability())
    return scored.drop("raw_features", "features", "rawPrediction", "probability")


def silhouette(model: PipelineModel, features: DataFrame) -> float:
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette")
    return evaluator.evaluate(model.transform(features))


def cluster_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("cluster").count().orderBy("cluster")


def cluster_profile(scored: DataFrame, max_rpm: float = 30, max_error_rate: float = 0.5) -> DataFrame:
    """Size and mean behaviour of every cluster; `is_anomaly` marks the fast or failing ones."""
    return (
        scored.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("request_count").alias("avg_requests"),
            F.avg("requests_per_minute").alias("avg_requests_per_minute"),
            F.avg("error_rate").alias("avg_error_rate"),
            F.avg("avg_response_time").alias("avg_response_time"),
            F.avg("url_diversity").alias("avg_url_diversity"),
        )
        .withColumn(
            "is_anomaly",
            (F.col("avg_requests_per_minute") > max_rpm) | (F.col("avg_error_rate") > max_error_rate),
        )
    )


def anomaly_clusters(scored: DataFrame, max_rpm: float = 30, max_error_rate: float = 0.5) -> DataFrame:
    return cluster_profile(scored, max_rpm, max_error_rate).filter("is_anomaly")


def confusion(scored: DataFrame, label: str = "is_attack") -> DataFrame:
    """Rows per (label, prediction)."""
    return scored.groupBy(F.col(label).cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")).count()


def classification_metrics(table: DataFrame) -> DataFrame:
    """Accuracy, weighted precision and recall and their F1, from a confusion table.

    Each row counts once for its true class and once for its predicted class.
    """
    n, none = F.col("count"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)

    def side(name: str, actual: Column, predicted: Column, tp: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"), actual.alias("actual"), predicted.alias("predicted"), tp.alias("tp")
        )

    per_class = (
        table.select(F.explode(F.array(side("label", n, none, hit), side("prediction", none, n, none))).alias("s"))
        .select("s.*")
        .groupBy("class")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    weighted = F.coalesce(ratio("tp", "predicted"), F.lit(0.0)) * F.col("actual")
    p, r = F.col("weighted_precision"), F.col("weighted_recall")
    return per_class.agg(
        ratio(F.sum("tp"), F.sum("actual")).alias("accuracy"),
        ratio(F.sum(weighted), F.sum("actual")).alias("weighted_precision"),
        ratio(F.sum("tp"), F.sum("actual")).alias("weighted_recall"),
    ).withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))


TRAINERS: dict[str, Callable[[DataFrame], PipelineModel]] = {
    "kmeans": fit_kmeans,
    "bisecting_kmeans": fit_bisecting,
    "random_forest": lambda features: fit_random_forest(split(features)[0]),
    "gradient_boosting": lambda features: fit_boosting(split(features)[0]),
}


def train_all(features: DataFrame, trainers=TRAINERS) -> tuple[dict[str, PipelineModel], dict[str, Exception]]:
    """Fit every model over one persisted input; a failing one is reported, not fatal."""
    models, failures = {}, {}
    with persisted(features) as kept:
        for name, fit in trainers.items():
            try:
                models[name] = fit(kept)
            except Exception as error:  # noqa: BLE001
                failures[name] = error
    return models, failures


def save_model(spark: SparkSession, model: PipelineModel, path: str, name: str, columns) -> None:
    """Model folder plus a one-row JSON description next to it."""
    model.write().overwrite().save(f"{path}/{name}")
    description = spark.range(1).select(
        F.lit(name).alias("model_name"),
        F.array(*[F.lit(c) for c in columns]).alias("feature_columns"),
        F.array(*[F.lit(type(s).__name__) for s in model.stages]).alias("stages"),
        F.current_timestamp().alias("trained_at"),
    )
    description.write.mode("overwrite").json(f"{path}/{name}_metadata")


def load_model(path: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/{name}")


def batch_predict(path: str, name: str, logs: DataFrame) -> DataFrame:
    """Score the windows of `logs` with a saved clustering model."""
    scored = score(load_model(path, name), window_features_v2(logs))
    return scored.select(
        "source_ip",
        "window_start",
        "request_count",
        "error_rate",
        "avg_response_time",
        F.col("cluster").alias("prediction"),
    )


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").parquet(path)
