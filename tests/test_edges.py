"""Rows exactly at thresholds, missing fields, ties and single rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.columns import severity_rank
from tidegauge.sources.logs import timed_between
from tidegauge.operators import live, profiles, rolling, rules, store, traffic, urls, windows
from tidegauge.schema import CANONICAL_ALERT, DetectionConfig


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def in_window(make_logs, n, errors=0, rt=1.0, urls=2):
    """n requests in the first minute of one source, so that four sliding windows see them all."""
    return make_logs(
        [(i * 0.1, "ip", f"/{i % urls}", 404 if i < errors else 200, rt) for i in range(n)]
    )


@pytest.mark.parametrize(
    "n,errors,rt,paths,expected",
    [
        (250, 0, 1.0, 2, set()),
        (251, 0, 1.0, 2, {"HIGH_REQUEST_RATE"}),
        (10, 7, 1.0, 2, set()),
        (10, 8, 1.0, 2, {"HIGH_ERROR_RATE"}),
        (4, 0, 5.0, 2, set()),
        (4, 0, 5.5, 2, {"SLOW_RESPONSE"}),
        (100, 0, 1.0, 1, set()),
        (101, 0, 1.0, 1, {"SCANNING_BEHAVIOR"}),
        (300, 300, 9.0, 1, {"HIGH_REQUEST_RATE", "HIGH_ERROR_RATE", "SLOW_RESPONSE", "SCANNING_BEHAVIOR"}),
    ],
)
def test_window_rules_are_strict(make_logs, n, errors, rt, paths, expected):
    found = windows.windowed_alerts(in_window(make_logs, n, errors, rt, paths)).collect()
    assert {t for r in found for t in r.alert_types} == expected
    assert len(found) == (5 if expected else 0)


def test_window_without_urls_is_no_scan(make_logs):
    logs = in_window(make_logs, 200, urls=1).withColumn("url", F.lit(None).cast("string"))
    assert windows.windowed_alerts(logs).count() == 0
    assert windows.windowed_stats(logs).agg(F.max("url_diversity")).first()[0] == 0


def test_window_size_must_be_a_multiple_of_the_slide(logs):
    with pytest.raises(ValueError):
        windows.windowed_stats(logs, "5 minutes", "2 minutes")


def test_rolling_time_edges(make_logs):
    logs = make_logs([(0, "a", "/", 200, 1.0), (59.999999, "a", "/", 200, 1.0), (60, "a", "/", 200, 1.0)])
    rates = {r.event_id: r.request_rate for r in rolling.rolling_basic(logs).collect()}
    assert rates == {0: 1, 1: 2, 2: 2}
    logs = make_logs([(0, "a", "/", 200, 1.0), (9.999999, "a", "/", 200, 1.0), (10, "a", "/", 200, 1.0)])
    assert {r.event_id: r.burst_rate for r in rolling.rolling_ml(logs).collect()} == {0: 1, 1: 2, 2: 2}
    logs = make_logs([(5, "a", "/1", 200, 1.0), (5, "a", "/2", 200, 1.0)])
    found = {r.event_id: (r.request_rate, r.url_diversity) for r in rolling.rolling_basic(logs).collect()}
    assert found == {0: (1, 1), 1: (2, 2)}


def test_rates_have_no_cap(make_logs):
    logs = make_logs([(i * 0.1, "a", "/", 200, 1.0) for i in range(400)])
    for sizes in ({}, {"hot_rows": 100, "block_rows": 50}):
        assert rolling.rolling_basic(logs, **sizes).agg(F.max("request_rate")).first()[0] == 400
        assert rolling.rolling_ml(logs, **sizes).agg(F.max("burst_rate")).first()[0] == 100


def test_colliding_alerts_are_all_kept(spark):
    """Alerts of one source and microsecond differ by detector and by request; repeats are one, the stronger."""
    from datetime import datetime

    at = datetime(2024, 1, 2, 3, 4, 5)
    rows = [
        (at, "a", "CRITICAL", "rule_based", "1"),
        (at, "a", "MEDIUM", "spark_streaming", "w"),
        (at, "a", "LOW", "rule_based", "2"),
        (at, "a", "LOW", "rule_based", "3"),
        (at, "a", "HIGH", "rule_based", "3"),
        (at, "a", "LOW", "rule_based", None),
        (at, "a", "MEDIUM", "rule_based", None),
    ]
    alerts = spark.createDataFrame(rows, "alert_ts timestamp, source_ip string, severity string, detection_method string, alert_id string")
    from tidegauge.schema import CANONICAL_ALERT

    full = alerts.select(
        *[F.col(f.name) if f.name in alerts.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CANONICAL_ALERT]
    )
    found = sorted(r.severity for r in store.to_alert_store(full).collect())
    assert found == ["CRITICAL", "HIGH", "LOW", "LOW", "MEDIUM", "MEDIUM"]


def test_rate_series_survives_stray_times(make_logs):
    day = 86_400
    logs = make_logs([(0, "a", "/", 200, 1.0), (12, "a", "/", 200, 1.0), (2 * day, "a", "/", 200, 1.0), (200_000 * day, "a", "/", 200, 1.0)])
    timed = timed_between(logs, datetime(2024, 1, 1), datetime(2100, 1, 1))
    rows = [tuple(r) for r in traffic.rate_series(timed).orderBy("bin_start").collect()]
    assert len(rows) == 2 * 17_280 + 1 and [n for _, n in rows[:4]] == [1, 0, 1, 0] and rows[-1][1] == 1


def test_rate_series_fills_a_silence_of_400_days(make_logs):
    day = 86_400
    logs = make_logs([(7, "a", "/", 200, 1.0), (8, "a", "/", 200, 1.0), (400 * day + 3, "a", "/", 200, 1.0)])
    found = traffic.rate_series(logs)
    assert found.count() == found.select("bin_start").distinct().count() == 400 * 17_280
    assert found.agg(F.sum("requests")).first()[0] == 3 and found.filter("requests > 0").count() == 2
    assert traffic.rate_series(logs.limit(0)).count() == 0


def test_rule_alert_contents(make_logs):
    logs = make_logs([(i * 0.1, "1.2.3.4", "/", 503, 6.0) for i in range(60)])
    alerts = rules.rule_alerts(rolling.rolling_basic(logs, keep_log=True))
    last = alerts.orderBy(F.desc("event_id")).first()
    assert [(a.type, a.severity) for a in last.alerts] == [
        ("high_request_rate", "HIGH"),
        ("high_error_rate", "MEDIUM"),
        ("slow_response", "LOW"),
        ("scanning_behavior", "MEDIUM"),
    ]
    assert [a.message for a in last.alerts] == [
        "IP 1.2.3.4 sending 60 requests/minute (threshold: 50)",
        "IP 1.2.3.4 has 100.00% error rate (threshold: 70.00%)",
        "IP 1.2.3.4 causing 6.00s avg response time",
        "IP 1.2.3.4 repeatedly accessing single URL with high frequency",
    ]
    assert last.severity == "HIGH" and last.sample_log.status_code == 503
    first = alerts.orderBy("event_id").first()
    assert first.severity == "MEDIUM" and first.request_rate == 1


def test_calendar_flags(make_logs):
    rows = [(d * 86400 + h * 3600, "a", "/", 200, 1.0) for d in range(7) for h in (8, 9, 17, 18)]
    logs = make_logs(rows, start=datetime(2024, 1, 1))  # a Monday
    for r in rolling.rolling_ml(logs).collect():
        assert r.is_business_hours == int(r.hour_of_day in (9, 17))
        assert r.is_weekend == int(r.event_timestamp.weekday() >= 5)
    for r in rolling.rolling_basic(logs).collect():
        assert r.day_of_week == r.event_timestamp.weekday()
    for r in logs.collect():
        assert r.day_of_week == r.event_timestamp.isoweekday() % 7 + 1


def test_single_rows(make_logs):
    logs = make_logs([(0, "a", "/", 200, 1.5)])
    profile = one(profiles.ip_profile(logs))
    assert (profile.duration_seconds, profile.requests_per_minute) == (0, 1.0)
    assert one(windows.window_features_v1(logs)).stddev_response_time == 0
    assert one(windows.window_features_v2(logs)).stddev_response_time == 0
    assert one(rolling.rolling_ml(logs)).std_response_time == 0
    assert one(windows.url_entropy(logs)).url_entropy == 0
    assert one(traffic.rate_series(logs)).requests == 1


def test_no_rows(make_logs):
    empty = make_logs([(0, "a", "/", 200, 1.5)]).filter("false")
    assert one(traffic.traffic_overview(empty)).total_requests == 0
    assert one(live.threat_level(empty)).level == "LOW"
    assert one(live.traffic_intensity(empty)).requests == 0
    assert windows.windowed_alerts(empty).count() == 0
    assert traffic.rate_series(empty).count() == 0


def test_empty_bins_are_filled(make_logs):
    logs = make_logs([(1, "a", "/", 200, 1.0), (21, "a", "/", 200, 1.0)])
    assert [r.requests for r in traffic.rate_series(logs).orderBy("bin_start").collect()] == [1, 0, 0, 0, 1]


def test_single_url_source_is_suspicious_and_risky(make_logs):
    logs = make_logs([(i * 10, "a", "/", 200, 1.0) for i in range(101)])
    assert profiles.suspicious_ips(logs).count() == 1
    assert profiles.suspicious_ips(logs.limit(100)).count() == 0
    assert one(profiles.risk_profiles(logs)).risk_score == pytest.approx(10.1 + 50 + 5)


def test_scanned_url_edges(make_logs):
    rows = [(i, "a", "/ten", 404, 1.0) for i in range(10)] + [(i, "a", "/eleven", 404, 1.0) for i in range(11)]
    rows += [(i, "a", "/half", 404 if i % 2 else 200, 1.0) for i in range(40)]
    assert [r.url for r in urls.scanned_urls(make_logs(rows)).collect()] == ["/eleven"]


def test_literal_ip_filter(make_logs):
    logs = make_logs([(0, "10.0.0.1", "/", 200, 1.0), (1, "10a0b0c1", "/", 404, 1.0)])
    assert [r.source_ip for r in live.select_logs(logs, ip="0.0.").collect()] == ["10.0.0.1"]
    assert [r.source_ip for r in live.select_logs(logs, ip="A0B").collect()] == ["10a0b0c1"]
    assert one(live.select_logs(logs, status_class="4xx")).status_code == 404


def canonical(spark, **values):
    row = {f.name: values.get(f.name) for f in CANONICAL_ALERT}
    return spark.createDataFrame([tuple(row.values())], CANONICAL_ALERT)


def item(severity):
    return ("t", severity, None, None)


def test_store_severity(spark):
    at = datetime(2024, 1, 1, 12, 0, 0, 5)
    severity = lambda **v: one(store.to_alert_store(canonical(spark, alert_ts=at, source_ip="a", **v))).severity
    assert severity(severity="LOW", alerts=[item("HIGH")]) == "LOW"
    assert severity(alerts=[item("LOW"), item("MEDIUM")]) == "MEDIUM"
    assert severity(alerts=[item(None)]) == "LOW"
    assert severity(alerts=[item("MEDIUM"), item("CRITICAL")]) == "CRITICAL"
    assert severity(alerts=[]) == "UNKNOWN"
    assert severity() == "UNKNOWN"


def test_store_keys_and_last_write(spark):
    at = datetime(2024, 1, 2, 3, 4, 5, 678)
    rule = canonical(spark, alert_ts=at, source_ip="1.2.3.4", alerts=[item("LOW")], detection_method="rule_based",
                     features={"request_rate": 7.0, "error_rate": 0.5})
    window = canonical(spark, alert_ts=at, source_ip="1.2.3.4", severity="HIGH", detection_method="spark_streaming")
    assert store.to_alert_store(rule, window, rule).count() == 2  # both detectors', the repeat once
    stored = store.to_alert_store(window, window)
    row = one(stored)
    assert row.rowkey.startswith("20240102030405000678_1_2_3_4_spark_streaming_") and row.severity == "HIGH"
    assert row.alert_types == []
    stats = store.ip_statistics(stored)
    assert one(stats).alert_count == 1
    merged = one(store.merge_statistics(stats, stats))
    assert (merged.alert_count, merged.last_severity) == (2, "HIGH")
    assert one(store.ip_history(store.to_alert_store(rule), stats, "1.2.3.4")).request_rate == 7.0
    assert store.alerts_by_ip(stored, "9.9.9.9").count() == 0


def test_severity_order(spark):
    df = spark.createDataFrame([("HIGH",), ("nonsense",), (None,), ("CRITICAL",)], "s string")
    assert [r[0] for r in df.select(severity_rank(F.col("s"))).collect()] == [3, 0, 0, 4]


def test_thresholds_come_from_the_configuration(make_logs):
    logs = in_window(make_logs, 10)
    assert windows.windowed_alerts(logs, DetectionConfig(request_rate=1.9)).count() == 5
    assert windows.windowed_alerts(logs, DetectionConfig(request_rate=2.0)).count() == 0


def test_mean_at_the_threshold_is_summed_in_the_order_of_requests(make_logs):
    """A mean of three values that add up to 15, or to a last digit more, as they come."""
    values = next(
        v for v in ((a / 100, b / 100, (1500 - a - b) / 100) for a in range(300, 500) for b in range(500, 600))
        if (v[0] + v[1]) + v[2] > 15 and v[0] + (v[1] + v[2]) <= 15 and (v[0] + v[2]) + v[1] <= 15
    )
    for order, slow in (((0, 1, 2), True), ((1, 2, 0), False), ((0, 2, 1), False)):
        logs = make_logs([(i, "10.0.0.1", f"/{'xyx'[i]}", 200, values[place]) for i, place in enumerate(order)])
        for parts in (1, 3, 5):
            found = windows.windowed_alerts(logs.repartition(parts), DetectionConfig(request_rate=1.0, scan_rate=100))
            assert found.count() == (5 if slow else 0), (order, parts)
