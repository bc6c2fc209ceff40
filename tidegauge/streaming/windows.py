"""Streaming twins of the window aggregates.

Exact distinct counts are not allowed inside a streaming aggregation. Append mode therefore
counts in two chained aggregations, first per URL (or source), then per window. Update mode
needs only to know whether a window saw a single URL, which smallest = largest tells exactly;
the number it shows is approximate and no rule uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where, is_error, ratio
from tidegauge.operators.windows import candidates, flag_windows, with_rates
from tidegauge.schema import DetectionConfig

CFG = DetectionConfig()


def _windowed(logs: DataFrame, cfg: DetectionConfig, *keys: str):
    return logs.withWatermark("event_timestamp", cfg.watermark).groupBy(
        F.window("event_timestamp", cfg.window, cfg.slide).alias("w"), *keys
    )


def closed_window_stats(logs: DataFrame, cfg: DetectionConfig = CFG) -> DataFrame:
    """Sliding statistics per source for append mode: each window once, when it is closed."""
    per_url = _windowed(logs, cfg, "source_ip", "url").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_n"),
        count_where(is_error()).alias("errors"),
        F.max("status_code").alias("hi"),
        F.min("status_code").alias("lo"),
        F.sum("bytes_sent").alias("b_sum"),
        F.count("bytes_sent").alias("b_n"),
    )
    stats = per_url.groupBy("w", "source_ip").agg(
        F.sum("n").alias("request_count"),
        ratio(F.sum("rt_sum"), F.sum("rt_n")).alias("avg_response_time"),
        F.sum("errors").alias("error_count"),
        F.count("url").alias("url_diversity"),
        F.max("hi").alias("max_status_code"),
        F.min("lo").alias("min_status_code"),
        ratio(F.sum("b_sum"), F.sum("b_n")).alias("avg_bytes_sent"),
    )
    return _flat(stats, cfg)


def running_window_stats(logs: DataFrame, cfg: DetectionConfig = CFG) -> DataFrame:
    """Sliding statistics per source for update mode: windows as they fill."""
    stats = _windowed(logs, cfg, "source_ip").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg("response_time").alias("avg_response_time"),
        count_where(is_error()).alias("error_count"),
        F.approx_count_distinct("url").alias("url_diversity"),
        (F.min("url") == F.max("url")).alias("single_url"),
        F.max("status_code").alias("max_status_code"),
        F.min("status_code").alias("min_status_code"),
        F.avg("bytes_sent").alias("avg_bytes_sent"),
    )
    return _flat(stats, cfg)


def _flat(stats: DataFrame, cfg: DetectionConfig) -> DataFrame:
    flat = stats.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")
    return with_rates(flat, cfg.window)


def closed_window_alerts(logs: DataFrame, cfg: DetectionConfig = CFG) -> DataFrame:
    """Alerts of closed windows, append mode. Response times are added as they come: a mean equal to the threshold may fall to either side."""
    return flag_windows(closed_window_stats(logs, cfg), cfg, F.col("url_diversity") == cfg.scan_urls)


def closed_window_candidates(logs: DataFrame, cfg: DetectionConfig = CFG) -> DataFrame:
    """Closed windows that break a rule, or may do so as sums are added in another order; see `windows.alerts_of`."""
    return candidates(closed_window_stats(logs, cfg), cfg)


def running_window_alerts(logs: DataFrame, cfg: DetectionConfig = CFG) -> DataFrame:
    """Alerts of windows as they fill, update mode."""
    if cfg.scan_urls != 1:
        raise ValueError("update mode can only tell whether a window saw a single URL")
    return flag_windows(running_window_stats(logs, cfg), cfg, F.col("single_url")).drop("single_url")


def closed_minute_stats(logs: DataFrame, cfg: DetectionConfig = CFG, size: str = "1 minute") -> DataFrame:
    """Volume, distinct sources, mean response time and errors per closed minute, append mode."""
    per_ip = (
        logs.withWatermark("event_timestamp", cfg.watermark)
        .groupBy(F.window("event_timestamp", size).alias("w"), "source_ip")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("response_time").alias("rt_sum"),
            F.count("response_time").alias("rt_n"),
            count_where(is_error()).alias("errors"),
        )
    )
    stats = per_ip.groupBy("w").agg(
        F.sum("n").alias("total_logs"),
        F.count("source_ip").alias("unique_ips"),
        ratio(F.sum("rt_sum"), F.sum("rt_n")).alias("avg_response_time"),
        F.sum("errors").alias("total_errors"),
    )
    return stats.select(F.col("w.start").alias("window_start"), "total_logs", "unique_ips", "avg_response_time", "total_errors")


def running_minute_stats(logs: DataFrame, cfg: DetectionConfig = CFG, size: str = "1 minute") -> DataFrame:
    """The same as minutes fill, with an approximate number of sources, update mode."""
    stats = (
        logs.withWatermark("event_timestamp", cfg.watermark)
        .groupBy(F.window("event_timestamp", size).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_logs"),
            F.approx_count_distinct("source_ip").alias("unique_ips"),
            F.avg("response_time").alias("avg_response_time"),
            count_where(is_error()).alias("total_errors"),
        )
    )
    return stats.select(F.col("w.start").alias("window_start"), "total_logs", "unique_ips", "avg_response_time", "total_errors")
