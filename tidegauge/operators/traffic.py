"""Traffic overview, distributions and time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where, is_error, ratio


def traffic_overview(logs: DataFrame) -> DataFrame:
    """One row: volume, distinct sources, date span and requests per source.

    Grouping by source first keeps the distinct count an ordinary count.
    """
    per_ip = logs.groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_date").alias("lo"), F.max("event_date").alias("hi")
    )
    return per_ip.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_requests"),
        F.count("source_ip").alias("unique_ips"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
    ).withColumn("requests_per_ip", ratio("total_requests", "unique_ips"))


def traffic_by(logs: DataFrame, column: str) -> DataFrame:
    """Requests per value of a calendar column, in calendar order."""
    return logs.groupBy(column).agg(F.count(F.lit(1)).alias("request_count")).orderBy(column)


def distribution(logs: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return logs.groupBy(column).count().orderBy(F.desc("count"), column)


def minute_stats(logs: DataFrame, size: str = "1 minute") -> DataFrame:
    """Volume, distinct sources, mean response time and errors per tumbling window."""
    return (
        logs.groupBy(F.window("event_timestamp", size).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_logs"),
            F.countDistinct("source_ip").alias("unique_ips"),
            F.avg("response_time").alias("avg_response_time"),
            count_where(is_error()).alias("total_errors"),
        )
        .select(F.col("w.start").alias("window_start"), "total_logs", "unique_ips", "avg_response_time", "total_errors")
    )


def _bin(column: str, size: str) -> Column:
    return F.window(column, size)["start"]


def rate_series(logs: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Requests per bin from the first to the last one, empty bins as 0, however long a silence.

    The days between the two ends are listed and dealt out, and each day's bins are made where it lies. Stray times
    stretch the series: leave them out first (sources.logs.timed_between). `size` must divide a day.
    """
    counts = logs.filter(F.col("event_timestamp").isNotNull()).groupBy(
        _bin("event_timestamp", size).alias("bin_start")
    ).agg(F.count(F.lit(1)).alias("requests"))
    ends = counts.agg(F.min("bin_start").alias("lo"), F.max("bin_start").alias("hi"))
    days = ends.select("lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day")).repartition("day")
    step = F.expr(f"INTERVAL {size}")
    first = F.greatest("lo", F.col("day").cast("timestamp"))
    last = F.least("hi", F.date_add("day", 1).cast("timestamp") - step)
    bins = days.select(F.explode(F.sequence(first, last, step)).alias("bin_start"))
    return bins.join(counts, "bin_start", "left").select(
        "bin_start", F.coalesce("requests", F.lit(0)).alias("requests")
    )


def timeline(logs: DataFrame, alerts: DataFrame, size: str = "1 minute", alert_time: str = "event_timestamp") -> DataFrame:
    """Log and alert counts side by side per time bin."""
    def counted(df: DataFrame, column: str, name: str, other: str) -> DataFrame:
        return (
            df.groupBy(_bin(column, size).alias("bin_start"))
            .agg(F.count(F.lit(1)).alias(name))
            .withColumn(other, F.lit(0).cast("bigint"))
        )

    both = counted(logs, "event_timestamp", "logs", "alerts").unionByName(
        counted(alerts, alert_time, "alerts", "logs")
    )
    return both.groupBy("bin_start").agg(F.sum("logs").alias("logs"), F.sum("alerts").alias("alerts"))
