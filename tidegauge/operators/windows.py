"""Event-time window aggregates: detection windows, model features, URL entropy."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where, is_client_error, is_error, is_server_error, ratio
from tidegauge.schema import METHOD_WINDOWS, DetectionConfig
from tidegauge.session import cut_lineage

#: Means whose distance from a threshold is within this share of it may be equal to it but for the rounding of their sum.
NEAR = 1e-9


def minutes(size: str) -> float:
    return pd.Timedelta(size).total_seconds() / 60


def windowed_stats(logs: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Sliding-window statistics per source.

    Rows are first summed per (pane, source, URL), a pane being one slide; only those sums are
    copied into the overlapping windows. Needs `size` to be a multiple of `slide`.
    """
    if pd.Timedelta(size) % pd.Timedelta(slide) != pd.Timedelta(0):
        raise ValueError("window size must be a multiple of the slide")
    panes = logs.groupBy(F.window("event_timestamp", slide)["start"].alias("pane"), "source_ip", "url").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_n"),
        count_where(is_error()).alias("errors"),
        F.max("status_code").alias("hi"),
        F.min("status_code").alias("lo"),
        F.sum("bytes_sent").alias("b_sum"),
        F.count("bytes_sent").alias("b_n"),
    )
    stats = panes.groupBy(F.window("pane", size, slide).alias("w"), "source_ip").agg(
        F.sum("n").alias("request_count"),
        ratio(F.sum("rt_sum"), F.sum("rt_n")).alias("avg_response_time"),
        F.sum("errors").alias("error_count"),
        F.countDistinct("url").alias("url_diversity"),
        F.max("hi").alias("max_status_code"),
        F.min("lo").alias("min_status_code"),
        ratio(F.sum("b_sum"), F.sum("b_n")).alias("avg_bytes_sent"),
    )
    return with_rates(
        stats.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w"),
        size,
    )


def with_rates(stats: DataFrame, size: str) -> DataFrame:
    return stats.withColumn("error_rate", ratio("error_count", "request_count")).withColumn(
        "requests_per_minute", F.col("request_count") / F.lit(minutes(size))
    )


def _rules(cfg: DetectionConfig, single_url: Column) -> dict[str, Column]:
    """Whether each rule is broken."""
    rate = F.col("requests_per_minute")
    flags = {
        "is_high_request_rate": rate > cfg.request_rate,
        "is_high_error_rate": F.col("error_rate") > cfg.error_rate,
        "is_slow_response": F.col("avg_response_time") > cfg.response_time,
        "is_scanning": (rate > cfg.scan_rate) & single_url,
    }
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}


def flag_windows(stats: DataFrame, cfg: DetectionConfig, single_url: Column) -> DataFrame:
    """Keep the windows that break a rule and name the rules, the severity and the method."""
    flags = _rules(cfg, single_url)
    # Alert names in rule order.
    names = ("HIGH_REQUEST_RATE", "HIGH_ERROR_RATE", "SLOW_RESPONSE", "SCANNING_BEHAVIOR")
    fired = F.array_compact(F.array(*[F.when(F.col(f), F.lit(n)) for f, n in zip(flags, names)]))
    return (
        stats.withColumns(flags)
        .filter(" OR ".join(flags))
        .withColumn("alert_types", fired)
        .withColumn(
            "severity",
            F.when(F.col("is_high_request_rate"), "HIGH")
            .when(F.col("is_high_error_rate"), "MEDIUM")
            .when(F.col("is_slow_response"), "LOW")
            .otherwise("MEDIUM"),
        )
        .withColumn("detection_method", F.lit(METHOD_WINDOWS))
    )


def _near(cfg: DetectionConfig) -> Column:
    """Whether the order in which response times are added may decide the rule on their mean."""
    gap = F.abs(F.col("avg_response_time") - F.lit(float(cfg.response_time)))
    return F.coalesce((gap > 0) & (gap <= NEAR * abs(cfg.response_time)) | (gap == 0) & (F.col("request_count") > 2), F.lit(False))


def mean_in_order(logs: DataFrame, found: DataFrame, cfg: DetectionConfig) -> DataFrame:
    """The windows `found` with their mean response time summed in the order of requests, whatever their number.

    A window of which `logs` has not as many requests as it counted keeps the mean that it has.
    """
    order = "event_id" if "event_id" in logs.columns else "event_timestamp"
    own = F.window("event_timestamp", cfg.window, cfg.slide)["start"]
    keys = found.select("window_start", F.col("source_ip").alias("_ip"))
    rows = logs.select(own.alias("_start"), "source_ip", F.col(order).alias("_order"), F.col("response_time").alias("_rt"))
    rows = rows.join(keys, F.col("_start").eqNullSafe(F.col("window_start")) & F.col("source_ip").eqNullSafe(F.col("_ip")))
    # A running sum adds row by row; it spills where a source has very many.
    part = Window.partitionBy("_start", "_ip").orderBy("_order", "_rt").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select("_start", "_ip", F.sum("_rt").over(part).alias("s"), F.count("_rt").over(part).alias("n"))
    means = running.groupBy("_start", "_ip").agg(ratio(F.max_by("s", "n"), F.max("n")).alias("_mean"), F.count(F.lit(1)).alias("_rows"))
    same = F.col("window_start").eqNullSafe(F.col("_start")) & F.col("source_ip").eqNullSafe(F.col("_ip"))
    whole = F.coalesce(F.col("_rows") == F.col("request_count"), F.lit(False))
    mean = F.when(whole, F.col("_mean")).otherwise(F.col("avg_response_time"))
    return found.join(means, same, "left").withColumn("avg_response_time", mean).select(*found.columns)


def _single_url(cfg: DetectionConfig) -> Column:
    return F.col("url_diversity") == cfg.scan_urls


def candidates(stats: DataFrame, cfg: DetectionConfig) -> DataFrame:
    """The windows that break a rule, or may do so if their response times are added in another order."""
    return stats.filter(reduce(Column.__or__, _rules(cfg, _single_url(cfg)).values(), _near(cfg)))


def windowed_alerts(logs: DataFrame, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Sliding windows of a source that break at least one rule.

    Sums of doubles depend on their order by a last digit, which decides the rule where a mean equals the threshold:
    the few such windows are summed anew in the order of their requests, so that every run finds the same.
    """
    # Windows are summed once and those in question kept, as both branches read them.
    found = cut_lineage(candidates(windowed_stats(logs, cfg.window, cfg.slide), cfg))
    near = _near(cfg)
    exact = mean_in_order(logs, found.filter(near), cfg)
    return flag_windows(found.filter(~near).unionByName(exact), cfg, _single_url(cfg))


def alerts_of(found: DataFrame, logs: Callable[[SparkSession], DataFrame], cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """The alerts of `candidates` that a stream has closed, decided as in `windowed_alerts`; `found` is read three times.

    `logs` gives the requests as a table, for example those that the stream reads, or its archive. It is asked only if the order of
    a sum decides a window, and then for the time of such windows.
    """
    near, single_url = _near(cfg), _single_url(cfg)
    span = found.filter(near).agg(F.min("window_start").alias("first"), F.max("window_end").alias("last")).first()
    if span["first"] is None:
        return flag_windows(found, cfg, single_url)
    time = F.col("event_timestamp")
    rows = logs(found.sparkSession).filter((time >= F.lit(span["first"])) & (time < F.lit(span["last"])))
    exact = mean_in_order(rows, found.filter(near), cfg)
    return flag_windows(found.filter(~near).unionByName(exact), cfg, single_url)


def attack_windows(
    logs: DataFrame,
    max_requests: float = 250,
    max_5xx: float = 50,
    max_rt: float = 5.0,
    size: str = "5 minutes",
    top: int | None = None,
) -> DataFrame:
    """Tumbling windows with too many requests, or many server errors while slow."""
    stats = logs.groupBy(F.window("event_timestamp", size).alias("w"), "source_ip").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg("response_time").alias("avg_response_time"),
        count_where(is_server_error()).alias("server_errors"),
    )
    found = stats.filter(
        (F.col("request_count") > max_requests)
        | ((F.col("server_errors") > max_5xx) & (F.col("avg_response_time") > max_rt))
    ).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "source_ip",
        "request_count",
        "avg_response_time",
        "server_errors",
    )
    if top is None:
        return found
    return found.orderBy(F.desc("request_count"), "window_start", "source_ip").limit(top)


def window_features_v1(
    logs: DataFrame, size: str = "5 minutes", min_rate: float = 50, min_error_rate: float = 0.5
) -> DataFrame:
    """Training features per (window, source) with the rule-made attack label.

    The label is a function of two of the features, so a classifier can reproduce it exactly.
    """
    stats = logs.groupBy(F.window("event_timestamp", size).alias("w"), "source_ip").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg("response_time").alias("avg_response_time"),
        F.max("response_time").alias("max_response_time"),
        F.stddev("response_time").alias("stddev_response_time"),
        F.sum("bytes_sent").alias("bytes_sent_total"),
        F.countDistinct("url").alias("url_diversity"),
        count_where(is_client_error()).alias("status_4xx_count"),
        count_where(is_server_error()).alias("status_5xx_count"),
        F.avg(F.hour("event_timestamp")).alias("hour_of_day"),
    )
    features = stats.select(
        F.col("w.start").alias("window_start"),
        "source_ip",
        "request_count",
        (F.col("request_count") / F.lit(minutes(size))).alias("request_rate"),
        "avg_response_time",
        "max_response_time",
        "stddev_response_time",
        "bytes_sent_total",
        "url_diversity",
        "status_4xx_count",
        "status_5xx_count",
        "hour_of_day",
        ratio(F.col("status_4xx_count") + F.col("status_5xx_count"), "request_count").alias("error_rate"),
    ).fillna(0)
    attack = (F.col("request_rate") > min_rate) & (F.col("error_rate") > min_error_rate)
    return features.withColumn("is_attack", attack.cast("double"))


def window_features_v2(logs: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Clustering features per (source, window)."""
    stats = logs.groupBy("source_ip", F.window("event_timestamp", size).alias("w")).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg("response_time").alias("avg_response_time"),
        F.max("response_time").alias("max_response_time"),
        F.stddev("response_time").alias("stddev_response_time"),
        count_where(is_error()).alias("error_count"),
        F.avg("bytes_sent").alias("avg_bytes_sent"),
        F.countDistinct("url").alias("url_diversity"),
    )
    return (
        with_rates(stats.withColumn("window_start", F.col("w.start")).drop("w"), size)
        .select(
            "source_ip",
            "window_start",
            "request_count",
            "avg_response_time",
            "max_response_time",
            "stddev_response_time",
            "error_count",
            "avg_bytes_sent",
            "url_diversity",
            "error_rate",
            "requests_per_minute",
        )
        .fillna(0)
    )


def class_balance(features: DataFrame, label: str = "is_attack") -> DataFrame:
    """One row: rows, attacks, normal rows and the attack share in percent."""
    return (
        features.agg(F.count(F.lit(1)).alias("total"), count_where(F.col(label) == 1).alias("attacks"))
        .withColumn("normal", F.col("total") - F.col("attacks"))
        .withColumn("attack_pct", ratio("attacks", "total") * 100)
    )


def url_entropy(logs: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Shannon entropy (bits) of URL frequencies per (window, source): two plain group-bys."""
    counts = logs.groupBy(F.window("event_timestamp", size)["start"].alias("window_start"), "source_ip", "url").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n")
    return counts.groupBy("window_start", "source_ip").agg(
        (F.log2(total) - F.sum(F.col("n") * F.log2("n")) / total).alias("url_entropy")
    )
