"""Rule detector over rolling features, and the messages alerts are published as."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import strongest
from tidegauge.schema import DetectionConfig


def alert_item(kind: str, severity: str | Column, message: Column, confidence: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        message.alias("message"),
        (F.lit(None) if confidence is None else confidence).cast("double").alias("confidence"),
    )


def rule_alerts(features: DataFrame, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Requests that break at least one rule, with the fired rules in `alerts`.

    Types, severities and message texts below are fixed values.
    """
    ip, rate = F.col("source_ip"), F.col("request_rate")
    rules = [
        (
            rate > cfg.request_rate,
            alert_item(
                "high_request_rate",
                "HIGH",
                F.format_string("IP %s sending %d requests/minute (threshold: %s)", ip, rate, F.lit(str(cfg.request_rate))),
            ),
        ),
        (
            F.col("error_rate") > cfg.error_rate,
            alert_item(
                "high_error_rate",
                "MEDIUM",
                F.format_string(
                    "IP %s has %.2f%% error rate (threshold: %.2f%%)",
                    ip,
                    F.col("error_rate") * 100,
                    F.lit(float(cfg.error_rate) * 100),
                ),
            ),
        ),
        (
            F.col("avg_response_time") > cfg.response_time,
            alert_item(
                "slow_response",
                "LOW",
                F.format_string("IP %s causing %.2fs avg response time", ip, F.col("avg_response_time")),
            ),
        ),
        (
            (rate > cfg.scan_rate) & (F.col("url_diversity") == cfg.scan_urls),
            alert_item(
                "scanning_behavior",
                "MEDIUM",
                F.format_string("IP %s repeatedly accessing single URL with high frequency", ip),
            ),
        ),
    ]
    fired = F.array_compact(F.array(*[F.when(condition, item) for condition, item in rules]))
    return (
        features.withColumn("alerts", fired)
        .filter(F.size("alerts") > 0)
        .withColumn("severity", strongest(F.col("alerts")))
    )


def alert_payload(alerts: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Window alerts as topic records: key = source, value = JSON message."""
    return alerts.select(
        F.col("source_ip").alias("key"),
        F.to_json(
            F.struct(
                (F.current_timestamp() if stamp is None else stamp).alias("timestamp"),
                "source_ip",
                "alert_types",
                "severity",
                "window_start",
                "window_end",
                F.struct(
                    "request_count",
                    "requests_per_minute",
                    "error_rate",
                    "avg_response_time",
                    "url_diversity",
                    "avg_bytes_sent",
                ).alias("metrics"),
                "detection_method",
            )
        ).alias("value"),
    )


def canonical_payload(alerts: DataFrame) -> DataFrame:
    """Canonical alerts of any detector as topic records."""
    return alerts.select(F.col("source_ip").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value"))
