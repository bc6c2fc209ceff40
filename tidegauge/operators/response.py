"""Response-time summaries, slow requests and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.quantiles import exact_quantiles


def response_summary(logs: DataFrame) -> DataFrame:
    """One row: mean, median, p95, p99 and maximum response time."""
    points = exact_quantiles(logs, "response_time", [0.5, 0.95, 0.99])
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
    quantiles = points.agg(at(0.5).alias("median"), at(0.95).alias("p95"), at(0.99).alias("p99"))
    quantiles = quantiles.select(F.struct("median", "p95", "p99")).scalar()
    return (
        logs.agg(F.avg("response_time").alias("avg_response_time"), F.max("response_time").alias("max_response_time"))
        .withColumn("q", quantiles)
        .select(
            "avg_response_time",
            F.col("q.median").alias("median_response_time"),
            F.col("q.p95").alias("p95_response_time"),
            F.col("q.p99").alias("p99_response_time"),
            "max_response_time",
        )
    )


def response_by_hour(logs: DataFrame) -> DataFrame:
    """Mean, p95 and request count per hour of day."""
    p95 = exact_quantiles(logs, "response_time", [0.95], keys=("hour",))
    means = logs.groupBy("hour").agg(
        F.avg("response_time").alias("avg_response_time"), F.count(F.lit(1)).alias("request_count")
    )
    # At most 25 rows on either side.
    return (
        means.alias("m")
        .join(p95.alias("q"), F.col("m.hour").eqNullSafe(F.col("q.hour")), "left")
        .select(
            "m.hour", "m.avg_response_time", F.col("q.value").alias("p95_response_time"), "m.request_count"
        )
        .orderBy("hour")
    )


def slow_threshold(logs: DataFrame, q: float = 0.95) -> Column:
    """The q-quantile of response time as a scalar subquery: no trip through the driver."""
    return exact_quantiles(logs, "response_time", [q]).select("value").scalar()


def slow_requests(logs: DataFrame, q: float = 0.95) -> DataFrame:
    """Requests above the q-quantile, with that threshold."""
    return logs.withColumn("threshold", slow_threshold(logs, q)).filter(
        F.col("response_time") > F.col("threshold")
    )


def slow_request_ips(logs: DataFrame, q: float = 0.95, top: int | None = None) -> DataFrame:
    """Sources with the most slow requests."""
    found = slow_requests(logs, q).groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("slow_request_count"), F.max("threshold").alias("threshold")
    )
    return found if top is None else found.orderBy(F.desc("slow_request_count"), "source_ip").limit(top)


def slow_request_total(logs: DataFrame, q: float = 0.95) -> DataFrame:
    """One row: the threshold, the requests above it, and all requests."""
    return logs.withColumn("threshold", slow_threshold(logs, q)).agg(
        F.max("threshold").alias("threshold"),
        F.count_if(F.col("response_time") > F.col("threshold")).alias("slow_request_count"),
        F.count(F.lit(1)).alias("request_count"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram over the column's range; the last bin includes the maximum."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    span = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    share = F.try_divide(F.col("v") - F.col("s.lo"), F.col("s.hi") - F.col("s.lo"))
    bucket = F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0))
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    return (
        values.withColumn("s", span)
        .groupBy(bucket.cast("int").alias("bucket"), "s")
        .count()
        .select(
            "bucket",
            (F.col("s.lo") + F.col("bucket") * width).alias("low"),
            (F.col("s.lo") + (F.col("bucket") + 1) * width).alias("high"),
            "count",
        )
    )
