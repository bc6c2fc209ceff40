"""Alert store: one canonical alert shape, keyed rows, per-source statistics and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import ratio, severity_rank, strongest
from tidegauge.schema import CANONICAL_ALERT, METHOD_ML, METHOD_RULES, ML_FEATURES

BASIC_FEATURES = (
    "request_rate",
    "error_rate",
    "avg_response_time",
    "url_diversity",
    "hour_of_day",
    "day_of_week",
)
WINDOW_METRICS = (
    "request_count",
    "requests_per_minute",
    "error_rate",
    "avg_response_time",
    "url_diversity",
    "avg_bytes_sent",
)


def _map(names) -> Column:
    pairs = [part for name in names for part in (F.lit(name), F.col(name).cast("double"))]
    return F.create_map(*pairs)


def _canonical(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(
        *[
            columns.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in CANONICAL_ALERT
        ]
    )


def canonical_rule_alerts(alerts: DataFrame) -> DataFrame:
    """Output of `rule_alerts` in the canonical shape."""
    return _canonical(
        alerts,
        alert_ts=F.col("event_timestamp"),
        source_ip=F.col("source_ip"),
        severity=F.col("severity"),
        detection_method=F.lit(METHOD_RULES),
        alert_id=F.col("event_id"),
        alerts=F.col("alerts"),
        features=_map(BASIC_FEATURES),
    )


def canonical_window_alerts(alerts: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Output of `windowed_alerts` in the canonical shape; the window end is the alert time."""
    items = F.transform(
        "alert_types",
        lambda t: F.struct(
            t.alias("type"),
            F.col("severity").alias("severity"),
            F.lit(None).cast("string").alias("message"),
            F.lit(None).cast("double").alias("confidence"),
        ),
    )
    return _canonical(
        alerts,
        alert_ts=F.col("window_end") if stamp is None else stamp,
        source_ip=F.col("source_ip"),
        severity=F.col("severity"),
        detection_method=F.col("detection_method"),
        alerts=items,
        metrics=_map(WINDOW_METRICS),
        window_start=F.col("window_start"),
        window_end=F.col("window_end"),
        alert_id=F.date_format("window_start", "yyyyMMddHHmmssSSSSSS"),
    )


def canonical_ml_alerts(alerts: DataFrame) -> DataFrame:
    """Output of `ensemble_alerts` in the canonical shape."""
    return _canonical(
        alerts,
        alert_ts=F.col("event_timestamp"),
        source_ip=F.col("source_ip"),
        severity=strongest(F.col("alerts")),
        detection_method=F.lit(METHOD_ML),
        alert_id=F.col("event_id"),
        alerts=F.col("alerts"),
        features=_map(ML_FEATURES),
        confidence=F.col("confidence"),
    )


def alert_severity(df: DataFrame) -> Column:
    """Own severity, else the strongest of the items, else UNKNOWN."""
    return F.coalesce(F.col("severity"), strongest(F.col("alerts")), F.lit("UNKNOWN"))


def rowkey(time: str = "alert_ts", ip: str = "source_ip") -> Column:
    """Time-ordered key: microsecond time, the source with dots as underscores, the detector, and what
    the alert is about (a hash of its contents where it does not say), so that different alerts keep apart."""
    content = F.hex(F.xxhash64("severity", F.to_json(F.struct("alerts", "features", "metrics"))))
    return F.concat_ws(
        "_",
        F.date_format(time, "yyyyMMddHHmmssSSSSSS"),
        F.regexp_replace(F.coalesce(F.col(ip), F.lit("unknown")), r"\.", "_"),
        F.coalesce("detection_method", F.lit("unknown")),
        F.coalesce("alert_id", content),
    )


def latest_per_key(rows: DataFrame) -> DataFrame:
    """One row per rowkey by an aggregate: repeats of one alert combine on the map side.

    Repeats carry the same time; the stronger severity stays, then the content decides.
    """
    columns = rows.columns
    rank = F.struct(severity_rank(F.col("severity")), F.to_json(F.struct("alerts", "features", "metrics")))
    return rows.groupBy("rowkey").agg(F.max_by(F.struct(*columns), rank).alias("row")).select("row.*")


def to_alert_store(*canonical: DataFrame) -> DataFrame:
    """Union of canonical alerts as store rows, one per rowkey."""
    alerts = reduce(lambda a, b: a.unionByName(b), canonical)
    rows = alerts.select(
        rowkey().alias("rowkey"),
        "alert_ts",
        "source_ip",
        alert_severity(alerts).alias("severity"),
        F.coalesce("detection_method", F.lit("unknown")).alias("detection_method"),
        F.coalesce(F.transform("alerts", lambda a: a["type"]), F.array().cast("array<string>")).alias("alert_types"),
        "alerts",
        "features",
        "metrics",
        F.to_date("alert_ts").alias("alert_date"),
    )
    return latest_per_key(rows)


def ip_statistics(store: DataFrame) -> DataFrame:
    """Alert count and the latest alert of every source."""
    latest = F.struct("alert_ts", "rowkey")
    document = F.to_json(F.struct("rowkey", "alert_ts", "severity", "detection_method", "alert_types"))
    return store.groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.max("alert_ts").alias("last_alert_time"),
        F.max_by("severity", latest).alias("last_severity"),
        F.max_by(document, latest).alias("latest_alert"),
    )


def merge_statistics(old: DataFrame, delta: DataFrame) -> DataFrame:
    """Statistics so far plus those of newly stored alerts: counts add up, the newer alert wins."""
    newer = F.col("old.last_alert_time").isNull() | (
        F.col("new.last_alert_time") >= F.col("old.last_alert_time")
    )
    pick = lambda c: F.when(newer & F.col("new.alert_count").isNotNull(), F.col(f"new.{c}")).otherwise(
        F.col(f"old.{c}")
    )
    return old.alias("old").join(
        delta.alias("new"), F.col("old.source_ip").eqNullSafe(F.col("new.source_ip")), "full_outer"
    ).select(
        F.coalesce("new.source_ip", "old.source_ip").alias("source_ip"),
        (F.coalesce("old.alert_count", F.lit(0)) + F.coalesce("new.alert_count", F.lit(0))).alias("alert_count"),
        *[pick(c).alias(c) for c in ("last_alert_time", "last_severity", "latest_alert")],
    )


def alerts_by_ip(store: DataFrame, ip: str, limit: int = 10) -> DataFrame:
    """Newest alerts of one source; the filter comes before the limit."""
    return (
        store.filter(F.col("source_ip") == ip)
        .orderBy(F.desc("rowkey"))
        .limit(limit)
        .select("rowkey", "alert_ts", "source_ip", "severity", "detection_method")
    )


def recent_alerts(store: DataFrame, limit: int = 50) -> DataFrame:
    """Newest alerts of all sources."""
    return (
        store.orderBy(F.desc("rowkey"))
        .limit(limit)
        .select("alert_ts", "source_ip", "severity", "detection_method")
    )


def alert_trends(store: DataFrame, by: str = "severity", hours: int | None = None) -> DataFrame:
    """Alerts and their share per severity, per method, or per hour (all, or the latest `hours` buckets)."""
    keys = {
        "severity": F.col("severity"),
        "method": F.col("detection_method"),
        "hour": F.date_format(F.date_trunc("hour", "alert_ts"), "yyyy-MM-dd HH:mm"),
    }
    counts = store.groupBy(keys[by].alias("key")).count()
    # The window sees one row per severity, method or hour.
    total = F.sum("count").over(Window.partitionBy())
    trends = counts.withColumn("pct", ratio("count", total) * 100)
    if by == "hour":
        trends = trends.orderBy(F.desc("key"))
        return trends if hours is None else trends.limit(hours)
    return trends.orderBy(F.desc("count"), "key") if by == "method" else trends.orderBy("key")


def top_offenders(stats: DataFrame, limit: int = 20) -> DataFrame:
    """Sources with the most alerts, ranked."""
    top = stats.filter(F.col("alert_count") > 0).orderBy(F.desc("alert_count"), "source_ip").limit(limit)
    # The ranking window sees at most `limit` rows.
    rank = F.row_number().over(Window.orderBy(F.desc("alert_count"), "source_ip"))
    return top.select(rank.alias("rank"), "source_ip", "alert_count", "last_alert_time", "last_severity")


def ip_lookup(stats: DataFrame, ip: str) -> DataFrame:
    """Statistics of one source."""
    return stats.filter(F.col("source_ip") == ip)


def ip_history(store: DataFrame, stats: DataFrame, ip: str, limit: int = 50) -> DataFrame:
    """Newest alerts of one source with its total; the statistics side is a single row."""
    total = stats.filter(F.col("source_ip") == ip).select("alert_count").scalar()
    value = lambda name: F.coalesce(F.col("features")[name], F.col("metrics")[name])
    rows = store.filter(F.col("source_ip") == ip).orderBy(F.desc("rowkey")).limit(limit)
    return rows.select(
        "alert_ts",
        "severity",
        "detection_method",
        F.coalesce(value("request_rate"), value("requests_per_minute")).alias("request_rate"),
        value("error_rate").alias("error_rate"),
        total.alias("alert_count"),
    )
