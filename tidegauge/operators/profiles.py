"""Per-source profiles, risk scores and automated clients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import (
    agent_matches,
    count_where,
    is_client_error,
    is_error,
    is_server_error,
    ratio,
)
from tidegauge.schema import BOT_PATTERNS


def ip_profile(logs: DataFrame) -> DataFrame:
    """Volume, errors, response time and lifetime of every source."""
    stats = logs.groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.countDistinct("url").alias("unique_urls"),
        F.avg("response_time").alias("avg_response_time"),
        F.max("response_time").alias("max_response_time"),
        count_where(is_error()).alias("error_count"),
        count_where(is_server_error()).alias("server_error_count"),
        F.sum("bytes_sent").alias("total_bytes"),
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
    )
    seconds = F.unix_timestamp("last_seen") - F.unix_timestamp("first_seen")
    return (
        stats.withColumn("error_rate", ratio("error_count", "total_requests"))
        .withColumn("duration_seconds", seconds)
        .withColumn(
            "requests_per_minute",
            F.when(
                F.col("duration_seconds") > 0,
                ratio("total_requests", F.col("duration_seconds") / 60),
            ).otherwise(F.col("total_requests").cast("double")),
        )
    )


def suspicious_ips(
    logs: DataFrame,
    threshold: float = 100,
    top: int | None = None,
    max_error_rate: float = 0.7,
    error_min_requests: int = 50,
    scan_min_requests: int = 100,
) -> DataFrame:
    """Profiles that are too fast, fail too often or hammer a single URL."""
    profile = ip_profile(logs)
    n = F.col("total_requests")
    found = profile.filter(
        (F.col("requests_per_minute") > threshold)
        | ((F.col("error_rate") > max_error_rate) & (n > error_min_requests))
        | ((F.col("unique_urls") == 1) & (n > scan_min_requests))
    )
    return found if top is None else found.orderBy(F.desc("requests_per_minute"), "source_ip").limit(top)


def risk_profiles(logs: DataFrame) -> DataFrame:
    """Error, diversity and load figures per source with an additive risk score.

    Rows collapse to one per (source, url, agent) before the two distinct counts expand them.
    """
    parts = logs.groupBy("source_ip", "url", "user_agent").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(is_client_error()).alias("c4"),
        count_where(is_server_error()).alias("c5"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_n"),
        F.max("response_time").alias("rt_max"),
    )
    stats = parts.groupBy("source_ip").agg(
        F.sum("n").alias("total_requests"),
        F.sum("c4").alias("client_errors"),
        F.sum("c5").alias("server_errors"),
        F.countDistinct("url").alias("unique_urls"),
        F.countDistinct("user_agent").alias("unique_agents"),
        ratio(F.sum("rt_sum"), F.sum("rt_n")).alias("avg_response_time"),
        F.max("rt_max").alias("max_response_time"),
    )
    return stats.withColumn(
        "risk_score",
        F.col("total_requests") / 10
        + F.col("server_errors") * 2
        + F.when(F.col("unique_urls") == 1, 50).otherwise(0)
        + F.col("max_response_time") * 5,
    )


def high_risk_ips(logs: DataFrame, min_score: float = 100, top: int | None = None) -> DataFrame:
    """Sources above `min_score`, riskiest first."""
    found = (
        risk_profiles(logs)
        .filter(F.col("risk_score") > min_score)
        .select("source_ip", "total_requests", "server_errors", "unique_urls", "risk_score")
    )
    return found if top is None else found.orderBy(F.desc("risk_score"), "source_ip").limit(top)


def bot_agents(logs: DataFrame, patterns=BOT_PATTERNS) -> DataFrame:
    """Distinct (source, agent) pairs of automated clients."""
    return logs.filter(agent_matches(patterns)).select("source_ip", "user_agent").distinct()
