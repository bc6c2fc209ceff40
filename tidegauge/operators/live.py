"""Monitoring aggregates: threat scores, recent-traffic indicators, display rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import agent_matches, count_where, is_error, ratio
from tidegauge.operators.response import histogram


def latest(logs: DataFrame, n: int) -> DataFrame:
    """The n newest requests."""
    return logs.orderBy(F.desc("event_timestamp"), F.desc("event_id")).limit(n)


def ip_counters(logs: DataFrame) -> DataFrame:
    """Requests, errors, summed response time and last activity per source; fits streams too."""
    return logs.groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("requests"),
        count_where(is_error()).alias("errors"),
        F.sum(F.coalesce("response_time", F.lit(0.0))).alias("total_response_time"),
        F.max("event_timestamp").alias("last_seen"),
    )


def _rates(logs: DataFrame) -> DataFrame:
    return ip_counters(logs).select(
        "source_ip",
        "requests",
        (ratio("errors", "requests") * 100).alias("error_pct"),
        ratio("total_response_time", "requests").alias("avg_response_time"),
        "last_seen",
    )


def top_sources(logs: DataFrame, n: int = 10) -> DataFrame:
    """Busiest sources with their error percentage."""
    return _rates(logs).orderBy(F.desc("requests"), "source_ip").limit(n)


def threat_scores(
    logs: DataFrame, max_error_pct: float = 50, max_requests: float = 100, max_rt: float = 5
) -> DataFrame:
    """Score 0..100 per source from errors, volume and slowness; suspicious above any of the limits."""
    errors, n, rt = F.col("error_pct"), F.col("requests"), F.col("avg_response_time")
    score = F.least(
        F.lit(100.0),
        errors * 0.4 + F.least(n, F.lit(200)) * 0.3 + F.least(rt, F.lit(10.0)) * 10,
    )
    return _rates(logs).select(
        "source_ip",
        "requests",
        "error_pct",
        "avg_response_time",
        score.alias("threat_score"),
        "last_seen",
        ((errors > max_error_pct) | (n > max_requests) | (rt > max_rt)).alias("is_suspicious"),
    )


def suspicious_scores(scores: DataFrame, n: int | None = None) -> DataFrame:
    """Suspicious sources with the score cut to a whole number, worst first; the `n` worst if given."""
    found = scores.filter("is_suspicious").withColumn("threat_score", F.col("threat_score").cast("int"))
    return found if n is None else found.orderBy(F.desc("threat_score"), "source_ip").limit(n)


def normal_ips(logs: DataFrame, top: int | None = None) -> DataFrame:
    """Sources with few errors, moderate volume and quick answers."""
    found = _rates(logs).filter(
        (F.col("error_pct") < 20) & (F.col("requests") < 100) & (F.col("avg_response_time") < 3)
    )
    return found if top is None else found.orderBy(F.desc("requests"), "source_ip").limit(top)


def score_histogram(scores: DataFrame, bins: int = 20) -> DataFrame:
    """Histogram of threat scores with the risk band of each bin's lower edge."""
    band = F.when(F.col("low") >= 70, "high").when(F.col("low") >= 40, "medium").otherwise("low")
    return histogram(scores, "threat_score", bins).select("bucket", band.alias("band"), "count")


def top_share(logs: DataFrame, column: str = "url", last: int = 200, top: int = 8) -> DataFrame:
    """Most frequent values among the newest rows with their share in percent."""
    recent = latest(logs.select("event_timestamp", "event_id", column), last)
    counts = recent.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias(column)).count()
    # At most `last` groups reach the window.
    total = F.sum("count").over(Window.partitionBy())
    return (
        counts.withColumn("pct", F.col("count") / total * 100).orderBy(F.desc("count"), column).limit(top)
    )


def traffic_intensity(logs: DataFrame, last: int = 100) -> DataFrame:
    """Volume, bytes and mean response time of the newest rows."""
    return latest(logs.select("event_timestamp", "event_id", "bytes_sent", "response_time"), last).agg(
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(F.sum("bytes_sent"), F.lit(0)).alias("total_bytes"),
        F.avg(F.coalesce("response_time", F.lit(0.0))).alias("avg_response_time"),
    )


def threat_level(logs: DataFrame, last: int = 100) -> DataFrame:
    """Indicators over the newest rows: many errors, many slow answers, many bots."""
    recent = latest(
        logs.select("event_timestamp", "event_id", "status_code", "response_time", "user_agent"), last
    )
    n = F.col("requests")
    indicators = (
        (F.col("errors") > n * 0.3).cast("int")
        + (F.col("slow") > n * 0.2).cast("int")
        + (F.col("bots") > n * 0.1).cast("int")
    )
    return (
        recent.agg(
            F.count(F.lit(1)).alias("requests"),
            count_where(is_error()).alias("errors"),
            count_where(F.col("response_time") > 5).alias("slow"),
            count_where(agent_matches(("bot",))).alias("bots"),
        )
        .withColumn("indicators", indicators)
        .withColumn(
            "level",
            F.when(F.col("indicators") >= 2, "HIGH").when(F.col("indicators") == 1, "MEDIUM").otherwise("LOW"),
        )
        .select("errors", "slow", "bots", "indicators", "level")
    )


def attack_rate(logs: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts per request in percent with its two verbal levels."""
    n_alerts = alerts.agg(F.count(F.lit(1))).scalar()
    pct = F.coalesce(ratio("alerts", "logs") * 100, F.lit(0.0))
    above = lambda high, mid, low: F.when(F.col("attack_pct") > 10, high).when(
        F.col("attack_pct") > 5, mid
    ).otherwise(low)
    return (
        logs.agg(F.count(F.lit(1)).alias("logs"))
        .withColumn("alerts", n_alerts)
        .withColumn("attack_pct", pct)
        .withColumn("threat_level", above("HIGH", "MEDIUM", "LOW"))
        .withColumn("rate_level", above("Critical", "Elevated", "Normal"))
    )


# Status classes offered as filters.
STATUS_CLASSES = {"2xx": (200, 299), "4xx": (400, 499), "5xx": (500, 599)}


def select_logs(logs: DataFrame, ip: str | None = None, status_class: str | None = None) -> DataFrame:
    """Rows whose source contains `ip` (any case, literal text) and whose status is in the class."""
    if ip:
        logs = logs.filter(F.lower("source_ip").contains(ip.lower()))
    if status_class:
        logs = logs.filter(F.col("status_code").between(*STATUS_CLASSES[status_class]))
    return logs


def capture_stats(logs: DataFrame, ip: str | None = None, status_class: str | None = None) -> DataFrame:
    """Rows, bytes, mean response time, protocols and sources of the selected rows."""
    return (
        select_logs(logs, ip, status_class)
        .withColumn("protocol", F.lit("HTTP"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum("bytes_sent"), F.lit(0)).alias("total_bytes"),
            F.avg("response_time").alias("avg_response_time"),
            F.countDistinct("protocol").alias("protocols"),
            F.countDistinct("source_ip").alias("unique_ips"),
        )
    )


def log_display(logs: DataFrame, n: int = 100) -> DataFrame:
    """The n newest requests, numbered oldest first, with a one-line summary."""
    number = F.row_number().over(Window.orderBy("event_timestamp", "event_id"))
    text = lambda c: F.col(c).cast("string")
    seconds = F.when(
        F.col("response_time") < 0.001,
        F.rtrim(F.col("response_time").cast("decimal(38,18)").cast("string"), F.lit("0")),
    ).otherwise(text("response_time"))
    info = F.concat(
        F.col("method"), F.lit(" "), F.col("url"), F.lit(" → "), text("status_code"),
        F.lit(" ("), text("bytes_sent"), F.lit(" bytes, "), seconds, F.lit("s)"),
    )
    return latest(logs, n).select(
        number.alias("no"),
        F.date_format("event_timestamp", "HH:mm:ss").alias("time"),
        "source_ip",
        F.lit("HTTP").alias("protocol"),
        "method",
        F.col("url").alias("request_uri"),
        F.col("status_code").alias("status"),
        F.col("response_time").alias("response_s"),
        F.col("bytes_sent").alias("length_bytes"),
        info.alias("info"),
    )


def alert_display(alerts: DataFrame) -> DataFrame:
    """One line per fired rule with the features that led to it."""
    item: Column = F.explode_outer("alerts")
    return alerts.select(
        "event_id", "event_timestamp", "source_ip", "request_rate", "error_rate", "avg_response_time",
        "url_diversity", item.alias("a"),
    ).select(
        "event_id",
        F.col("event_timestamp").alias("alert_ts"),
        "source_ip",
        "request_rate",
        "error_rate",
        "avg_response_time",
        "url_diversity",
        F.format_string("[%s] %s", F.col("a.severity"), F.col("a.type")).alias("rule"),
        F.col("a.message").alias("message"),
    )


def window_alert_display(alerts: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Seven columns of a window alert for a console."""
    return alerts.select(
        (F.current_timestamp() if stamp is None else stamp).alias("alert_timestamp"),
        "source_ip",
        "alert_types",
        "severity",
        "requests_per_minute",
        "error_rate",
        "avg_response_time",
    )
