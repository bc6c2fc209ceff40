"""Schemas, thresholds and fixed values shared by batch and streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("bytes_sent", T.IntegerType()),
        T.StructField("response_time", T.DoubleType()),
        T.StructField("user_agent", T.StringType()),
    ]
)
LOG_FIELDS = LOG_SCHEMA.fieldNames()

PARTITION_KEYS = ("year", "month", "day", "hour")

ALERT_ITEM = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)

CANONICAL_ALERT = T.StructType(
    [
        T.StructField("alert_ts", T.TimestampType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("detection_method", T.StringType()),
        T.StructField("alerts", T.ArrayType(ALERT_ITEM)),
        T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("confidence", T.DoubleType()),
        # What the alert is about: the request or the window. Alerts of one time and source keep apart by it.
        T.StructField("alert_id", T.StringType()),
    ]
)

# Severity names from weakest to strongest.
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

# Detection-method labels found in stored alerts.
METHOD_RULES = "rule_based"
METHOD_WINDOWS = "spark_streaming"
METHOD_ML = "mahout_ml"

# User-agent fragments that mark automated clients.
BOT_PATTERNS = ("bot", "crawler", "spider", "curl", "wget")

# Rolling model features in vector order.
ML_FEATURES = (
    "request_rate",
    "burst_rate",
    "error_rate",
    "error_4xx_rate",
    "error_5xx_rate",
    "avg_response_time",
    "max_response_time",
    "std_response_time",
    "avg_bytes",
    "total_bytes",
    "url_diversity",
    "url_entropy",
    "method_diversity",
    "get_ratio",
    "agent_diversity",
    "is_bot",
    "hour_of_day",
    "is_business_hours",
    "is_weekend",
)

# Model inputs taken from the two kinds of window features.
WINDOW_V1_FEATURES = (
    "request_rate",
    "error_rate",
    "avg_response_time",
    "max_response_time",
    "bytes_sent_total",
    "url_diversity",
    "status_4xx_count",
    "status_5xx_count",
    "hour_of_day",
)
WINDOW_V2_FEATURES = (
    "request_count",
    "requests_per_minute",
    "avg_response_time",
    "max_response_time",
    "stddev_response_time",
    "error_count",
    "error_rate",
    "avg_bytes_sent",
    "url_diversity",
)


@dataclass(frozen=True)
class DetectionConfig:
    """Rule thresholds; every comparison is strict (`>`)."""

    request_rate: float = 50
    error_rate: float = 0.7
    response_time: float = 5.0
    scan_rate: float = 20
    scan_urls: int = 1
    window: str = "5 minutes"
    slide: str = "1 minute"
    watermark: str = "10 minutes"
    cooldown_seconds: float = 30


@dataclass(frozen=True)
class ModelConfig:
    """Settings of the clustering, forest and ensemble steps."""

    kmeans_k: int = 4
    outlier_k: int = 3
    max_iter: int = 20
    trees: int = 100
    depth: int = 10
    bins: int = 32
    boost_iter: int = 20
    boost_depth: int = 5
    seed: int = 42
    outlier_distance: float = 2.5
    contamination: float = 0.1
    retrain_every: int = 500
    # Newest rows that a refit takes.
    retrain_over: int = 1000
    # Rows without which nothing is fitted, and attacks over which the classifier is.
    min_rows: int = 100
    min_positives: int = 10
