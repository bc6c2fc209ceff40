"""URL access statistics and scan detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where, ratio


def url_stats(logs: DataFrame, top: int | None = None) -> DataFrame:
    """Accesses, distinct sources, mean response time and 404s per URL."""
    stats = logs.groupBy("url").agg(
        F.count(F.lit(1)).alias("access_count"),
        F.countDistinct("source_ip").alias("unique_ips"),
        F.avg("response_time").alias("avg_response_time"),
        count_where(F.col("status_code") == 404).alias("not_found_count"),
    )
    return stats if top is None else stats.orderBy(F.desc("access_count"), "url").limit(top)


def scanned_urls(logs: DataFrame, min_404: int = 10, min_ratio: float = 0.5, top: int | None = None) -> DataFrame:
    """URLs that are mostly asked for in vain."""
    found = url_stats(logs).filter(
        (F.col("not_found_count") > min_404) & (ratio("not_found_count", "access_count") > min_ratio)
    )
    return found if top is None else found.orderBy(F.desc("not_found_count"), "url").limit(top)
