"""Reading and archiving logs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.plans.analyses import analyze, inspect_alerts, live_dashboard
from tidegauge.schema import LOG_FIELDS
from tidegauge.session import ensure_checkpoint_dir
from tidegauge.sources import logs as source
from tidegauge.sources import sinks
from tidegauge.sources.events import raw_text_logs


def record(timestamp, **extra):
    base = dict(timestamp=timestamp, source_ip="1.1.1.1", method="GET", url="/", status_code=200, bytes_sent=1,
                response_time=0.5, user_agent="x")
    return {**base, **extra}


@pytest.fixture
def folder(tmp_path):
    def write(*lines):
        path = tmp_path / "in"
        path.mkdir(exist_ok=True)
        (path / "part.json").write_text("\n".join(l if isinstance(l, str) else json.dumps(l) for l in lines))
        return str(path)

    return write


def test_timestamps(spark, folder):
    path = folder(
        record("2024-01-01T10:00:00.000001"), record("2024-01-01T10:00:00Z"), record("2024-01-01T10:00:00+02:00"),
        record("yesterday"), record(None), "{broken",
    )
    raw = source.read_logs(spark, path)
    stamps = sorted(str(r.event_timestamp) for r in source.normalize_logs(raw).collect())
    assert stamps == ["2024-01-01 08:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00.000001", "None", "None", "None"]
    assert source.quarantine(raw).count() == 3


def test_missing_fields_stay_null(spark, folder):
    path = folder({"timestamp": "2024-01-01T10:00:00"}, record("2024-01-01T10:00:00", status_code="oops"))
    rows = source.normalize_logs(source.read_logs(spark, path)).collect()
    assert len(rows) == 2 and all(r.status_code is None and r.is_error is None for r in rows)


def test_topic_records(spark):
    value = json.dumps(record("2024-01-01T10:00:00")).encode()
    messages = spark.createDataFrame(
        [(b"1.1.1.1", value, datetime(2024, 1, 1)), (None, b"not json", datetime(2024, 1, 1))],
        "key binary, value binary, timestamp timestamp",
    )
    rows = source.parse_messages(messages).collect()
    assert rows[0].source_ip_key == rows[0].source_ip == "1.1.1.1" and rows[0].kafka_timestamp
    assert rows[1].source_ip is None


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_archive_round_trip_and_pruning(spark, tmp_path, logs, fmt):
    base = str(tmp_path / "raw")
    raw = raw_text_logs(logs)
    sinks.archive(raw, base, fmt)
    back = source.read_logs(spark, base, fmt)
    assert set(back.columns) >= {"year", "month", "day", "hour"}
    assert back.select(LOG_FIELDS).exceptAll(raw).count() == 0 and back.count() == raw.count()
    some = source.logs_between(spark, base, datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1, 5), fmt)
    assert some.count() == logs.filter(
        "event_timestamp >= timestamp'2024-01-01 01:00' AND event_timestamp < timestamp'2024-01-01 01:05'"
    ).count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "concat(year" in filters
    assert {r.hour for r in some.select("hour").distinct().collect()} == {"01"}


def test_sample_limit_listing(spark, tmp_path, logs):
    base = str(tmp_path / "raw")
    sinks.archive(raw_text_logs(logs), base, "json")
    half = source.read_logs(spark, base, sample_fraction=0.5).count()
    assert 0.4 * 1000 < half < 0.6 * 1000
    assert source.read_logs(spark, base, limit=7).count() == 7
    listing = source.storage_listing(spark, base, "json", n=2).collect()
    assert len(listing) == 2 and all("hour=" in r.file_path and r.size_mb > 0 for r in listing)


def test_checkpoint_dir_is_kept_or_required(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first


def test_only_needed_columns_are_read(spark):
    from tidegauge.operators.traffic import traffic_by
    from tidegauge.sources.events import event_logs

    # Not the tables of the cached `logs` fixture, whose plan would be answered from the cache.
    plan = traffic_by(event_logs(spark, "/root/testdata/sf0.01"), "hour")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_analyze_runs_every_family(logs):
    with analyze(logs) as results:
        assert len(results) == 14
        assert results["method_distribution"].agg(F.sum("count")).first()[0] == 1000
    with analyze(logs, "urls") as results:
        assert set(results) == {"top_urls", "scanned_urls"}


def test_inspect_alerts(spark, tmp_path, logs):
    from tidegauge.operators.store import ip_statistics
    from tidegauge.plans.queries import alert_store

    stored = alert_store(logs).cache()
    stats = ip_statistics(stored)
    ip = stored.first().source_ip
    for action in ("recent", "trends", "offenders", "ip-history", "report"):
        for df in inspect_alerts(stored, stats, action, ip=ip).values():
            assert df.columns and df.count() >= 0
    path = str(tmp_path / "report")
    inspect_alerts(stored, stats, "export", path=path)
    exported = spark.read.json(path)
    assert exported.filter("key = 'total_alerts'").first().value == stored.count()
    with pytest.raises(ValueError):
        inspect_alerts(stored, stats, "dance")


def test_dashboard(logs):
    from tidegauge.operators.windows import attack_windows

    results = live_dashboard(logs, attack_windows(logs, 8, 2, 2.5))
    assert all(df.count() >= 0 for df in results.values())
    assert results["response_histogram"].agg(F.sum("count")).first()[0] == 200


def test_scratch_is_cleared(spark):
    from tidegauge.session import clear_scratch, scratch_path

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) >= 1
    assert clear_scratch(spark) == 0


def test_quarantine_by_bounds(spark):
    rows = [("2024-01-01T00:00:00",), ("1999-01-01T00:00:00",), ("2200-01-01T00:00:00",), ("soon",), (None,)]
    raw = spark.createDataFrame(rows, "timestamp string")
    found = source.quarantine(raw, datetime(2020, 1, 1), datetime(2100, 1, 1)).collect()
    assert sorted((r.timestamp or "", r.reason) for r in found) == [
        ("", "unreadable"), ("1999-01-01T00:00:00", "stray"), ("2200-01-01T00:00:00", "stray"), ("soon", "unreadable")
    ]
    assert source.quarantine(raw).count() == 2


def test_listing_counts_rows(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/a")
    listed = source.storage_listing(spark, str(tmp_path)).collect()
    assert len(listed) == 3 and sum(r.rows for r in listed) == 1000 and all(r.size_mb > 0 and r.modified for r in listed)


def scanned_rows(df):
    """Rows that the scans of a finished query have given out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_lookup_reads_what_can_hold_the_source(spark, tmp_path):
    from tidegauge.operators import lookup

    path = f"{tmp_path}/lookup"
    rows = spark.range(400_000).selectExpr(
        "concat('2024010', id % 4 + 1, '-', lpad(id, 8, '0')) as rowkey", "cast(concat('2024-01-0', id % 4 + 1) as timestamp) as alert_ts",
        "concat('10.0.', (id div 4) % 500, '.1') as source_ip", "'LOW' as severity", "'rule_based' as detection_method",
        "repeat(md5(cast(id as string)), 4) as note", "cast(concat('2024-01-0', id % 4 + 1) as date) as alert_date")
    lookup.write_lookup(rows, path, group_bytes=256 << 10)
    found = lookup.newest_of_source(spark, path, "10.0.7.1", 5)
    want = rows.filter("source_ip = '10.0.7.1'").orderBy(F.desc("rowkey")).limit(5).select(*lookup.SHOWN)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.collect()]
    one_day = spark.read.parquet(path).filter("alert_date = '2024-01-04' and source_ip = '10.0.7.1'")
    unfiltered = spark.read.parquet(path).filter("alert_date = '2024-01-04'")
    assert scanned_rows(unfiltered) == 100_000
    assert 200 <= scanned_rows(one_day) < 20_000  # a few row groups of many
    assert lookup.newest_of_source(spark, path, "10.9.9.9").count() == 0
    assert [r.rowkey[:8] for r in lookup.newest_alerts(spark, path, 3).collect()] == ["20240104"] * 3
    many = lookup.newest_of_source(spark, path, "10.0.7.1", 450).collect()
    assert len(many) == 450 and {r.rowkey[:8] for r in many} == {"20240104", "20240103", "20240102"}


def test_days_of_a_streamed_store_are_compacted(spark, tmp_path):
    from test_streams import canonical

    from tidegauge.operators import lookup
    from tidegauge.streaming import store as stream_store

    for batch in range(2):
        alerts = canonical(spark, *[(m, f"ip{m % 3}", "LOW") for m in range(30 * batch, 30 * batch + 40)], (None, "ip1", "HIGH"))
        stream_store.store_batch(alerts, batch, f"{tmp_path}/store")
    days = [r[0] for r in stream_store.read_store(spark, f"{tmp_path}/store").select("alert_date").distinct().filter("alert_date is not null").collect()]
    lookup.compact_days(spark, f"{tmp_path}/store", f"{tmp_path}/lookup", days)
    found = lookup.newest_of_source(spark, f"{tmp_path}/lookup", "ip1", 100)
    assert found.count() == sum(m % 3 == 1 for m in range(70))
