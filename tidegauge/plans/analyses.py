"""Entry points that run a whole family of results: batch analyses, alert reports, detection streams."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators import live, profiles, report, response, store, traffic, urls, windows
from tidegauge.operators.ml import persisted
from tidegauge.schema import DetectionConfig
from tidegauge.sources import sinks
from tidegauge.streaming import windows as stream_windows
from tidegauge.streaming.jobs import start_all

Results = dict[str, DataFrame]

ANALYSES: dict[str, Callable[[DataFrame, float], Results]] = {
    "traffic": lambda logs, threshold: {
        "traffic_overview": traffic.traffic_overview(logs),
        "traffic_by_hour": traffic.traffic_by(logs, "hour"),
        "traffic_by_day_of_week": traffic.traffic_by(logs, "day_of_week"),
        "method_distribution": traffic.distribution(logs, "method"),
        "status_distribution": traffic.distribution(logs, "status_code"),
    },
    "suspicious": lambda logs, threshold: {
        "suspicious_ips": profiles.suspicious_ips(logs, threshold, top=20)
    },
    "attacks": lambda logs, threshold: {"attack_windows": windows.attack_windows(logs, top=20)},
    "urls": lambda logs, threshold: {
        "top_urls": urls.url_stats(logs, top=20),
        "scanned_urls": urls.scanned_urls(logs, top=10),
    },
    "response": lambda logs, threshold: {
        "response_summary": response.response_summary(logs),
        "response_by_hour": response.response_by_hour(logs),
        "slow_request_ips": response.slow_request_ips(logs),
    },
    "threat": lambda logs, threshold: {
        "high_risk_ips": profiles.high_risk_ips(logs),
        "bot_agents": profiles.bot_agents(logs),
    },
}


@contextmanager
def analyze(logs: DataFrame, which: str = "all", threshold: float = 100):
    """Lazy results by name over one kept input, which is let go on leaving:

    with analyze(logs, "urls") as results:
        results["top_urls"].show()
    """
    names = list(ANALYSES) if which == "all" else [which]
    with persisted(logs) as kept:
        yield {key: df for name in names for key, df in ANALYSES[name](kept, threshold).items()}


def inspect_alerts(
    stored: DataFrame, stats: DataFrame, action: str, ip: str | None = None, limit: int = 20, path: str | None = None
) -> Results:
    """The alert-store actions: recent, trends, offenders, ip-history, report, export."""
    if action == "recent":
        return {"recent": store.recent_alerts(stored, limit)}
    if action == "trends":
        return {by: store.alert_trends(stored, by, 24 if by == "hour" else None) for by in ("severity", "method", "hour")}
    if action == "offenders":
        return {"offenders": store.top_offenders(stats, limit)}
    if action == "ip-history":
        return {"alerts": store.ip_history(stored, stats, ip, limit), "statistics": store.ip_lookup(stats, ip)}
    if action in ("report", "export"):
        result = report.threat_report(stored, stats)
        if action == "export":
            sinks.export_report(result, path)
        return {"report": result, "critical": report.critical_sources(stats)}
    raise ValueError(f"unknown action {action!r}")


def start_detection(
    logs: DataFrame,
    output: str,
    target: str,
    checkpoint: str,
    cfg: DetectionConfig = DetectionConfig(),
    trigger: dict | None = None,
    fmt: str = "kafka",
    **options,
) -> list[StreamingQuery]:
    """Streaming window detection plus minute statistics; output is topic, console or both."""
    alerts = stream_windows.running_window_alerts(logs, cfg)
    starters = []
    if output in ("topic", "both"):
        starters.append(
            lambda: sinks.start_alert_topic(
                alerts, target, f"{checkpoint}/topic", fmt=fmt, trigger=trigger, **options
            )
        )
    if output in ("console", "both"):
        starters.append(lambda: sinks.start_alert_console(alerts, trigger))
    minutes = stream_windows.running_minute_stats(logs, cfg)
    starters.append(
        lambda: minutes.writeStream.outputMode("update")
        .format("console")
        .option("truncate", "false")
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
    return start_all(*starters)


def live_dashboard(logs: DataFrame, alerts: DataFrame) -> Results:
    """The monitoring results over one log table and its alerts."""
    scores = live.threat_scores(logs)
    return {
        "attack_rate": live.attack_rate(logs, alerts),
        "rate_5s": traffic.rate_series(logs),
        "top_sources": live.top_sources(logs),
        "suspicious": live.suspicious_scores(scores),
        "normal": live.normal_ips(logs, top=10),
        "score_histogram": live.score_histogram(scores),
        "response_histogram": response.histogram(live.latest(logs, 200), "response_time"),
        "recent_methods": traffic.distribution(live.latest(logs, 200), "method"),
        "recent_statuses": traffic.distribution(live.latest(logs, 200), "status_code"),
        "top_urls": live.top_share(logs),
        "intensity": live.traffic_intensity(logs),
        "threat_level": live.threat_level(logs),
        "log_display": live.log_display(logs),
    }
