"""Live detectors: alerts of rules and models, kept apart in time, published and stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.ensemble import Ensemble, ensemble_alerts, score_ensemble
from tidegauge.operators.rules import rule_alerts
from tidegauge.operators.store import canonical_ml_alerts, canonical_rule_alerts
from tidegauge.schema import DetectionConfig, ModelConfig
from tidegauge.streaming.stateful import cooldown_stateful, rolling_ml_stateful, rolling_stateful
from tidegauge.streaming.store import parse_alerts, start_alert_store


#: Whole microseconds in JSON.
_STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _spaced(canonical: DataFrame, seconds: float) -> DataFrame:
    """The canonical alerts that the cooldown keeps; they wait for their turn as JSON."""
    waiting = canonical.select(
        F.col("alert_id").alias("event_id"),
        "source_ip",
        F.col("alert_ts").alias("event_timestamp"),
        F.to_json(F.struct(*canonical.columns), _STAMPS).alias("value"),
    )
    return parse_alerts(cooldown_stateful(waiting, seconds))


def live_rule_alerts(logs: DataFrame, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Canonical rule alerts of a log stream, at most one a source within the cooldown."""
    alerts = rule_alerts(rolling_stateful(logs, delay=cfg.watermark), cfg)
    return _spaced(canonical_rule_alerts(alerts), cfg.cooldown_seconds)


def live_ml_alerts(
    logs: DataFrame, model: Ensemble, cfg: DetectionConfig = DetectionConfig(), models: ModelConfig = ModelConfig()
) -> DataFrame:
    """Canonical alerts of a log stream by a fitted ensemble, at most one a source within the cooldown."""
    scored = score_ensemble(model, rolling_ml_stateful(logs, delay=cfg.watermark))
    alerts = ensemble_alerts(scored, models.outlier_distance)
    return _spaced(canonical_ml_alerts(alerts), cfg.cooldown_seconds)


def start_publishing(
    alerts: DataFrame, target: str, checkpoint: str, fmt: str = "kafka", trigger: dict | None = None, **options
) -> StreamingQuery:
    """Canonical alerts as JSON records keyed by source: to a topic, or to a folder of files of the same records."""
    records = alerts.select(F.col("source_ip").alias("key"), F.to_json(F.struct(*alerts.columns), _STAMPS).alias("value"))
    writer = records.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    writer = writer.option("topic" if fmt == "kafka" else "path", target).options(**options)
    return (writer.trigger(**trigger) if trigger else writer).start()


def open_alert_topics(spark: SparkSession, topics: list[str], fmt: str = "kafka", **options) -> DataFrame:
    """The canonical alerts of several topics (or folders of published files) as one stream."""
    if fmt == "kafka":
        stream = spark.readStream.format(fmt).option("subscribe", ",".join(topics))
        return parse_alerts(stream.option("startingOffsets", "earliest").options(**options).load())
    streams = [spark.readStream.format(fmt).schema("key string, value string").options(**options).load(t) for t in topics]
    out = streams[0]
    for stream in streams[1:]:
        out = out.union(stream)
    return parse_alerts(out)


def start_store_of_topics(
    spark: SparkSession, topics: list[str], path: str, checkpoint: str, fmt: str = "kafka", trigger: dict | None = None, **options
) -> StreamingQuery:
    """Everything that detectors publish, into the alert store and the statistics."""
    return start_alert_store(open_alert_topics(spark, topics, fmt, **options), path, checkpoint, trigger=trigger)
