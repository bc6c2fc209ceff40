"""Threat report over the alert store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import ratio
from tidegauge.schema import METHOD_RULES, METHOD_WINDOWS


def critical_sources(stats: DataFrame, min_alerts: int = 5) -> DataFrame:
    """Sources that need attention first."""
    return stats.filter(F.col("alert_count") >= min_alerts)


def threat_report(store: DataFrame, stats: DataFrame, min_alerts: int = 5) -> DataFrame:
    """The whole report as (section, key, value) rows.

    One pass over the store counts per (severity, method); grouping sets over those few rows
    give the totals, the severities and the methods. The statistics are read once.
    """
    counts = store.groupBy("severity", "detection_method").count()

    def of(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0))

    severity, method = F.col("severity"), F.col("detection_method")
    sets = counts.groupingSets([[severity], [method], []], "severity", "detection_method").agg(
        F.grouping("severity").alias("no_severity"),
        F.grouping("detection_method").alias("no_method"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
        of(severity.isin("HIGH", "CRITICAL")).alias("strong"),
        of(method == METHOD_WINDOWS).alias("windows"),
        of(method == METHOD_RULES).alias("rules"),
    )
    sources = stats.agg(
        F.struct(
            F.count("source_ip").alias("n"),
            F.count_if(F.col("alert_count") >= min_alerts).alias("critical"),
        ).alias("s")
    ).scalar()
    is_total = (F.col("no_severity") == 1) & (F.col("no_method") == 1)
    # The window sees the handful of rows of the grouping sets.
    total = F.max(F.when(is_total, F.col("n"))).over(Window.partitionBy())
    facts = sets.withColumn("total", total).withColumn("s", sources)

    def rows(*items: tuple[str, str | Column, Column]) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(section).alias("section"),
                    (F.lit(key) if isinstance(key, str) else key).alias("key"),
                    value.cast("double").alias("value"),
                )
                for section, key, value in items
            ]
        )

    n, share = F.col("n"), ratio("n", "total") * 100
    overall = rows(
        ("overall", "total_alerts", n),
        ("overall", "unique_sources", F.col("s.n")),
        ("overall", "avg_alerts_per_source", n / F.greatest("s.n", F.lit(1))),
        ("critical", "critical_sources", F.col("s.critical")),
        ("recommendation", "block_critical_sources", (F.col("s.critical") > 0).cast("int")),
        ("recommendation", "high_severity_rate", (F.col("strong") > n * 0.3).cast("int")),
        ("recommendation", "use_more_detectors", (F.col("windows") < F.col("rules") * 0.5).cast("int")),
    )
    report = F.when(is_total, overall).when(
        F.col("no_severity") == 0, rows(("severity_count", severity, n), ("severity_pct", severity, share))
    ).otherwise(rows(("method_count", method, n), ("method_pct", method, share)))
    return facts.select(F.explode(report).alias("r")).select("r.*")
