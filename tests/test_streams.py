"""Streams: late rows, restarts, replays, several queries, retraining."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import rolling, store, windows
from tidegauge.plans.analyses import start_detection
from tidegauge.schema import CANONICAL_ALERT, LOG_FIELDS, METHOD_ML, METHOD_RULES, DetectionConfig, ModelConfig
from tidegauge.sources import sinks
from tidegauge.sources.logs import normalize_logs, read_log_stream
from tidegauge.streaming import jobs, stateful
from tidegauge.streaming import store as stream_store
from tidegauge.streaming import windows as stream_windows
from tidegauge.streaming.drain import drain

ONCE = {"availableNow": True}
START = datetime(2024, 1, 1)


@pytest.fixture
def feed(tmp_path):
    """Append files of (minutes, ip, url, status) requests to a folder."""
    path = tmp_path / "in"
    path.mkdir()

    def add(name, *rows):
        lines = [
            json.dumps(dict(zip(LOG_FIELDS, [
                (START + timedelta(minutes=m)).isoformat(), ip, "GET", url, status, 10, 1.0, "x"])))
            for m, ip, url, status in rows
        ]
        (path / f"{name}.json").write_text("\n".join(lines))
        return str(path)

    return add


def logs_of(spark, path):
    return normalize_logs(read_log_stream(spark, path, "json", max_per_trigger=1))


def run(df, base, trigger=ONCE):
    query = (
        df.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
        .trigger(**trigger).start()
    )
    try:
        assert query.awaitTermination(90)
    finally:
        query.stop()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/out")


def test_late_rows_and_restart(spark, feed, tmp_path):
    cfg = DetectionConfig(window="5 minutes", slide="5 minutes")
    path = feed("1", (1, "a", "/1", 200), (2, "a", "/2", 404), (12, "a", "/1", 200))
    out = run(stream_windows.closed_window_stats(logs_of(spark, path), cfg), tmp_path)
    assert out.count() == 0  # watermark at minute 2
    feed("2", (3, "a", "/3", 200), (20, "a", "/1", 200))  # minute 3 is late but inside the watermark
    out = run(stream_windows.closed_window_stats(logs_of(spark, path), cfg), tmp_path)
    assert [(r.window_start.minute, r.request_count, r.url_diversity) for r in out.collect()] == [(0, 3, 3)]
    feed("3", (4, "a", "/4", 200), (40, "a", "/1", 200))  # minute 4 is beyond it
    out = run(stream_windows.closed_window_stats(logs_of(spark, path), cfg), tmp_path)
    found = sorted((r.window_start.minute, r.request_count) for r in out.collect())
    assert found == [(0, 3), (10, 1), (20, 1)]


def test_running_alerts_equal_batch(spark, feed, tmp_path):
    rows = [(i / 100, "a", "/", 503) for i in range(60)] + [(i / 2, "b", f"/{i}", 200) for i in range(9)]
    path = feed("1", *rows)
    cfg = DetectionConfig(request_rate=10, scan_rate=5)
    alerts = stream_windows.running_window_alerts(logs_of(spark, path), cfg)
    sinks.start_alert_topic(alerts, f"{tmp_path}/t", f"{tmp_path}/cp", fmt="json", trigger=ONCE).awaitTermination()
    sent = spark.read.json(f"{tmp_path}/t")
    message = json.loads(sent.first().value)
    assert set(message) == {"timestamp", "source_ip", "alert_types", "severity", "window_start", "window_end",
                            "metrics", "detection_method"}
    batch = windows.windowed_alerts(normalize_logs(spark.read.schema(
        "timestamp string, source_ip string, method string, url string, status_code int, bytes_sent int, "
        "response_time double, user_agent string").json(path)), cfg)
    assert sent.count() == batch.count() > 0
    assert {r.key for r in sent.collect()} == {"a"}


def test_stateful_operators_over_two_runs(spark, feed, tmp_path):
    early = [(i * 0.1, f"ip{i % 3}", f"/{i % 5}", 200 if i % 4 else 500) for i in range(90)]
    late = [(9 + i * 0.1, f"ip{i % 4}", f"/{i % 7}", 200 if i % 3 else 500) for i in range(90)]
    path = feed("1", *early)
    run(stateful.rolling_stateful(logs_of(spark, path)), tmp_path / "r")
    feed("2", *late, (8.5, "ip0", None, 500), (8.6, "ip0", "", 200), (20, "ip1", "/9", 200))
    run(stateful.rolling_stateful(logs_of(spark, path)), tmp_path / "r")
    feed("3", (12, "ip0", "/late", 500), (11.5, "ip1", "/later", 200))  # late, but within the delay
    run(stateful.rolling_stateful(logs_of(spark, path)), tmp_path / "r")
    feed("9", (10_000, None, None, None))  # an end mark
    found = run(stateful.rolling_stateful(logs_of(spark, path)), tmp_path / "r")
    every = normalize_logs(spark.read.schema(
        "timestamp string, source_ip string, method string, url string, status_code int, bytes_sent int, "
        "response_time double, user_agent string").json(path))
    columns = ["event_id", "source_ip", "request_rate", "error_rate", "avg_response_time", "url_diversity"]
    expected = rolling.rolling_basic(every).filter("source_ip IS NOT NULL").select(columns).collect()
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, expected))

    alerts = logs_of(spark, path).select("event_id", "source_ip", "event_timestamp")
    kept = run(stateful.cooldown_stateful(alerts, 60, delay="10 minutes"), tmp_path / "c")
    gaps = kept.selectExpr(
        "event_timestamp - lag(event_timestamp) OVER (PARTITION BY source_ip ORDER BY event_timestamp) AS gap"
    ).filter("gap IS NOT NULL")
    assert gaps.count() > 0 and gaps.filter("gap < INTERVAL 60 SECONDS").count() == 0


def test_url_ttl_is_accepted(spark, feed, tmp_path):
    path = feed("1", (0, "a", "/1", 200), (1, "a", "/2", 200))
    feed("2", (200, "a", "/3", 200))
    run(stateful.rolling_stateful(logs_of(spark, path), url_ttl_ms=3_600_000), tmp_path)
    feed("3", (10_000, None, None, None))  # an end mark, in a run of its own
    found = run(stateful.rolling_stateful(logs_of(spark, path), url_ttl_ms=3_600_000), tmp_path)
    assert [r.url_diversity for r in found.orderBy("event_timestamp").collect()] == [1, 2, 1]  # two were forgotten


def canonical(spark, *rows):
    full = [
        tuple({"alert_ts": None if m is None else START + timedelta(minutes=m), "source_ip": ip, "severity": s,
               "detection_method": "rule_based"}.get(f.name) for f in CANONICAL_ALERT)
        for m, ip, s in rows
    ]
    return spark.createDataFrame(full, CANONICAL_ALERT)


def test_store_batches_can_be_replayed(spark, tmp_path):
    path = str(tmp_path)
    first = canonical(spark, (0, "a", "LOW"), (1, "a", "HIGH"), (2, "b", "LOW"))
    second = canonical(spark, (3, "a", "MEDIUM"), (60 * 24, "c", "LOW"))
    stream_store.store_batch(first, 0, path)
    stream_store.store_batch(second, 1, path)
    stream_store.store_batch(second, 1, path)
    stored, stats = stream_store.read_store(spark, path), stream_store.read_statistics(spark, path)
    assert stored.count() == 5
    found = {r.source_ip: (r.alert_count, r.last_severity) for r in stats.collect()}
    assert found == {"a": (3, "MEDIUM"), "b": (1, "LOW"), "c": (1, "LOW")}
    again = store.ip_statistics(stored).select("source_ip", "alert_count", "last_alert_time", "last_severity")
    assert again.exceptAll(stats.drop("latest_alert")).count() == 0


def test_store_counts_an_alert_once_however_often_it_is_sent(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    monkeypatch.setattr(stream_store, "FILTER_WORDS", 1)  # a filter that soon holds everything: exact all the same
    sent = [canonical(spark, *[(m, f"ip{m % 5}", "LOW") for m in range(20 * b, 20 * b + 30)]) for b in range(4)]
    for batch_id, alerts in enumerate(sent):
        stream_store.store_batch(alerts, batch_id, path)
    for batch_id in (2, 3):  # the last ones once more, as after a failure
        stream_store.store_batch(sent[batch_id], batch_id, path)
    stats = stream_store.read_statistics(spark, path)
    assert stats.agg(F.sum("alert_count")).first()[0] == 90 == stream_store.read_store(spark, path).count()


def test_store_batches_read_no_more_as_the_day_fills(spark, tmp_path):
    """Bytes that a batch reads do not depend on what the day holds already."""
    path = str(tmp_path)
    sc = spark.sparkContext

    def stages():
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._gateway.jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).inputBytes() for i in range(found.size())}

    cost = []
    for batch_id in range(12):
        alerts = canonical(spark, *[(20 * batch_id + m / 100, f"ip{m % 40}", "LOW") for m in range(400)]).coalesce(1)
        alerts.write.parquet(f"{path}/in{batch_id}")
        last = max(stages())
        stream_store.store_batch(spark.read.parquet(f"{path}/in{batch_id}"), batch_id, f"{path}/store")
        cost.append(sum(n for stage, n in stages().items() if stage > last))
    # Statistics have their size from the second batch on; their sources are the same ones throughout.
    assert max(cost[3:]) < 1.2 * min(cost[3:])


def test_alert_topics_meet_in_one_store(spark, tmp_path):
    rule, window = canonical(spark, (0, "a", "LOW")), canonical(spark, (1, "b", "HIGH"))
    from tidegauge.operators.rules import canonical_payload

    for name, alerts in (("one", rule), ("two", window)):
        canonical_payload(alerts).write.json(f"{tmp_path}/{name}")
    topics = [spark.readStream.schema("key string, value string").json(f"{tmp_path}/{n}") for n in ("one", "two")]
    alerts = stream_store.parse_alerts(topics[0].unionByName(topics[1]))
    stream_store.start_alert_store(alerts, f"{tmp_path}/s", f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    assert {r.severity for r in stream_store.read_store(spark, f"{tmp_path}/s").collect()} == {"LOW", "HIGH"}


def test_stored_windows_at_the_threshold_are_decided_in_the_order_of_requests(spark, make_logs, tmp_path):
    """0.1 + 0.2 + 0.3 is more than 0.6 in this order, and 0.6 if summed by URL as the stream does."""
    cfg = DetectionConfig(window="5 minutes", slide="5 minutes", request_rate=100, error_rate=1, response_time=0.2, scan_rate=100)
    rows = [(0, "10.0.0.1", "/x", 200, 0.1), (1, "10.0.0.1", "/y", 200, 0.2), (2, "10.0.0.1", "/y", 200, 0.3), (3, "10.0.0.2", "/x", 200, 0.1)]
    make_logs(rows).write.parquet(f"{tmp_path}/in")
    logs = spark.read.parquet(f"{tmp_path}/in")

    def start(stream):
        found = stream_windows.closed_window_candidates(stream, cfg)
        alerts = lambda batch: store.canonical_window_alerts(windows.alerts_of(batch, lambda session: logs, cfg))
        return stream_store.start_alert_store(found, f"{tmp_path}/s", f"{tmp_path}/cp", trigger=ONCE, prepare=alerts)

    drain(spark.readStream.schema(logs.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/end", start)
    stored = stream_store.read_statistics(spark, f"{tmp_path}/s").collect()
    assert [(r.source_ip, r.alert_count) for r in stored] == [("10.0.0.1", 1)]
    assert windows.windowed_alerts(logs, cfg).count() == 1
    # A table that lacks requests of the window does not decide it, nor does it take the window away.
    streamed = windows.windowed_stats(logs, cfg.window, cfg.slide).withColumn("avg_response_time", F.lit(0.6 / 3))
    assert windows.alerts_of(streamed, lambda session: logs, cfg).count() == 1
    assert windows.alerts_of(streamed, lambda session: logs.filter("event_id != 1"), cfg).count() == 0
    assert windows.alerts_of(streamed.withColumn("avg_response_time", F.lit(0.2 + 1e-12)), lambda session: logs.limit(0), cfg).count() == 2


def test_archive_restart_repeats_nothing(spark, feed, tmp_path):
    for name, minute in (("1", 0), ("2", 61)):
        path = feed(name, (minute, "a", "/", 200))
        raw = read_log_stream(spark, path, "json")
        sinks.start_archive(raw, f"{tmp_path}/raw", f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    hours = spark.read.parquet(f"{tmp_path}/raw").groupBy("hour").count().collect()
    assert len(hours) == 2 and all(r["count"] == 1 for r in hours)


def test_queries_start_and_stop_together(spark, feed, tmp_path):
    path = feed("1", (0, "a", "/", 200))
    logs = logs_of(spark, path)
    listener = jobs.ProgressCounter()
    spark.streams.addListener(listener)
    queries = start_detection(logs, "both", f"{tmp_path}/t", f"{tmp_path}/cp", trigger={"processingTime": "1 second"},
                              fmt="json")
    assert len(queries) == 3
    for query in queries:
        query.processAllAvailable()
    jobs.run_until_one_ends(spark, queries, timeout=1)
    assert not any(q.isActive for q in queries)
    spark.streams.removeListener(listener)
    assert sum(listener.rows.values()) >= 1

    broken = lambda: (_ for _ in ()).throw(RuntimeError("no"))
    good = lambda: logs.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/n").start()
    with pytest.raises(RuntimeError):
        jobs.start_all(good, broken)
    assert not spark.streams.active


def test_counters(spark, logs):
    counted, observation = jobs.counted(logs, "run", alert="status_code >= 500")
    counted.write.format("noop").mode("overwrite").save()
    found = observation.get
    assert found["rows"] == 1000 and found["alerts"] == logs.filter("status_code >= 500").count()


def test_retraining(spark, tmp_path, logs):
    labelled = rolling.pseudo_labels(rolling.rolling_ml(logs), 3, 0.4, 2)
    labelled.repartition(2).write.parquet(f"{tmp_path}/in")
    features = spark.readStream.schema(labelled.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    cfg = ModelConfig(trees=5, depth=3, retrain_every=600, retrain_over=300)
    jobs.start_retraining(features, f"{tmp_path}/m", f"{tmp_path}/cp", cfg, ONCE).awaitTermination()
    from tidegauge.operators.ensemble import Ensemble

    assert [p.name for p in (tmp_path / "m" / "models").iterdir()] == ["version=1"]
    model = Ensemble.load(spark, f"{tmp_path}/m/models/version=1", with_classifier=False)
    assert model.forest.offset is not None
    jobs.fit_collected(spark, f"{tmp_path}/m", cfg)
    assert (tmp_path / "m" / "models" / "last").exists()


def test_retraining_keeps_the_newest_rows_over_restarts(spark, tmp_path, logs):
    labelled = rolling.pseudo_labels(rolling.rolling_ml(logs), 3, 0.4, 2).orderBy("event_timestamp", "event_id")
    rows = labelled.collect()
    cfg = ModelConfig(trees=3, depth=2, retrain_every=250, retrain_over=150)
    (tmp_path / "in").mkdir()

    def feed_and_run(k):
        part = spark.createDataFrame(rows[100 * k : 100 * (k + 1)], labelled.schema).coalesce(1)
        part.write.parquet(f"{tmp_path}/part{k}")
        for file in (tmp_path / f"part{k}").glob("*.parquet"):
            file.rename(tmp_path / "in" / f"{k}.parquet")
        features = spark.readStream.schema(labelled.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        jobs.start_retraining(features, f"{tmp_path}/m", f"{tmp_path}/cp", cfg, ONCE).awaitTermination()

    for k in range(6):  # each run is a restart
        feed_and_run(k)
    assert len(list((tmp_path / "m" / "features").glob("batch_id=*"))) <= 3
    newest = jobs.newest_collected(spark, f"{tmp_path}/m", 150)
    assert {r.event_id for r in newest.collect()} == {r.event_id for r in rows[450:600]}
    assert sorted(p.name for p in (tmp_path / "m" / "models").iterdir()) == ["version=2", "version=4"]
    small = ModelConfig(trees=3, depth=2, retrain_over=50)
    jobs.fit_collected(spark, f"{tmp_path}/m", small)
    assert not (tmp_path / "m" / "models" / "last").exists()  # fewer rows than a fit needs


def test_live_model_alerts_are_published_and_stored(spark, tmp_path, logs):
    """Streamed scores equal those of a batch with the same saved model; alerts go over a topic into the store."""
    from tidegauge.operators import cooldown, ensemble
    from tidegauge.streaming import detect
    from tidegauge.streaming.drain import drain

    labelled = rolling.pseudo_labels(rolling.rolling_ml(logs), 3, 0.4, 2)
    models = ModelConfig(trees=5, depth=3, outlier_distance=6.0, min_positives=0)
    ensemble.fit_ensemble(labelled, models).save(spark, f"{tmp_path}/model")
    model = ensemble.Ensemble.load(spark, f"{tmp_path}/model")
    raw = f"{tmp_path}/raw"
    logs.write.parquet(raw)
    stream = spark.readStream.schema(logs.schema).parquet(raw)
    cfg = DetectionConfig(request_rate=3, error_rate=0.4, response_time=4.0, scan_rate=1)

    def publish(name, build):
        def start(source):
            alerts = build(source)
            return detect.start_publishing(alerts, f"{tmp_path}/topics/{name}", f"{tmp_path}/cp/{name}", "json", ONCE)

        drain(stream, f"{tmp_path}/end/{name}", start)

    publish("ml", lambda s: detect.live_ml_alerts(s, model, cfg, models))
    publish("rules", lambda s: detect.live_rule_alerts(s, cfg))
    topics = [f"{tmp_path}/topics/{name}" for name in ("ml", "rules")]
    detect.start_store_of_topics(spark, topics, f"{tmp_path}/store", f"{tmp_path}/cp/store", "json", ONCE).awaitTermination()
    found = stream_store.read_store(spark, f"{tmp_path}/store")

    scored = ensemble.ensemble_alerts(ensemble.score_ensemble(model, rolling.rolling_ml(logs)), models.outlier_distance)
    batch = cooldown.apply_cooldown(scored, cfg.cooldown_seconds)
    ml = found.filter(F.col("detection_method") == METHOD_ML)
    assert ml.count() == batch.count() > 0
    assert {(r.source_ip, r.alert_ts) for r in ml.collect()} == {(r.source_ip, r.event_timestamp) for r in batch.collect()}
    assert found.filter(F.col("detection_method") == METHOD_RULES).count() > 0
    stats = stream_store.read_statistics(spark, f"{tmp_path}/store")
    assert stats.agg(F.sum("alert_count")).first()[0] == found.count()


def test_late_rows_are_those_that_stateful_operators_drop(spark, tmp_path):
    """The side output with in_force=2 against numRowsDroppedByWatermark of a stateful stream over the same files."""
    from tidegauge.streaming import late

    (tmp_path / "in").mkdir()
    batches = [[0, 5, 30], [1, 29, 31, 60], [2, 19, 21, 45, 90], [3, 49, 51, 95], [70, 79, 81, 120], [1, 100]]
    for k, minutes in enumerate(batches):
        lines = [json.dumps({"timestamp": (START + timedelta(minutes=m)).isoformat(), "source_ip": f"ip{k}", "url": f"/{k}/{i}"}) for i, m in enumerate(minutes)]
        lines += [json.dumps({"timestamp": "never", "source_ip": "x"}), json.dumps({"timestamp": "2150-01-01T00:00:00", "source_ip": "y"})]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(lines))
    raw = read_log_stream(spark, f"{tmp_path}/in", "json", max_per_trigger=1)
    limits = {"earliest": datetime(2020, 1, 1), "latest": datetime(2100, 1, 1)}
    late.start_split(raw, f"{tmp_path}/out", f"{tmp_path}/cp", timedelta(minutes=10), in_force=2, **limits, trigger=ONCE).awaitTermination()
    found = late.read_part(spark, f"{tmp_path}/out", "late")

    logs = normalize_logs(raw).filter(F.col("event_timestamp").between(limits["earliest"], limits["latest"]))
    distinct = logs.withWatermark("event_timestamp", "10 minutes").dropDuplicatesWithinWatermark(["event_id"])
    query = distinct.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp2").trigger(**ONCE).start()
    query.awaitTermination()
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["numInputRows"]]
    per_batch = {r.batch_id: r["count"] for r in found.groupBy("batch_id").count().collect()}
    assert [per_batch.get(b, 0) for b in range(len(batches))] == dropped and sum(dropped) > 3
    bad = late.read_part(spark, f"{tmp_path}/out", "quarantine").groupBy("reason").count().collect()
    assert {(r.reason, r["count"]) for r in bad} == {("unreadable", 6), ("stray", 6)}
    total = late.read_part(spark, f"{tmp_path}/out", "ontime").count() + found.count()
    assert total == sum(map(len, batches))


class Memory:
    """A state handle in memory, which tells how many rows are held at most in one piece."""

    class Map(dict):
        def getValue(self, k):
            return self.get(tuple(k))

        def updateValue(self, k, v):
            self[tuple(k)] = tuple(v)

        def removeKey(self, k):
            self.pop(tuple(k), None)

        def containsKey(self, k):
            return tuple(k) in self

        def iterator(self):
            return iter(list(self.items()))

    class Value:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, v):
            self.value = tuple(v)

        def clear(self):
            self.value = None

    def getMapState(self, name, *schemas):
        return self.__dict__.setdefault(name, Memory.Map())

    def getValueState(self, name, *schemas):
        return self.__dict__.setdefault(name, Memory.Value())

    def registerTimer(self, ms):
        self.timer = ms


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("full", [2_000, 10**9])  # slots kept by second, or whole
def test_a_hot_source_leaves_in_bounded_frames(spark, monkeypatch, full):
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(stateful, "FULL_ROWS", full)
    monkeypatch.setattr(stateful, "FRAME_ROWS", 1_000)
    rng = np.random.default_rng(4)
    n = 60_000
    start = int(START.timestamp() * 1e6)
    rows = pd.DataFrame({"event_id": np.arange(n), "us": start + rng.integers(0, 3_000_000_000, n), "url": [f"/{i % 50}" for i in range(n)],
                         "error": rng.integers(0, 2, n), "rt": rng.random(n), "hour_of_day": 1, "day_of_week": 2})
    operator, state = stateful.RollingFeatures(None), Memory()
    operator.init(state)
    frames = []
    for k in range(12):
        chunk = rows.iloc[5_000 * k : 5_000 * (k + 1)]
        list(operator.handleInputRows(("a",), iter([chunk]), None))
    held = max(len(stateful._unpacked(v[0], operator.arrow)) for v in state.held.values())
    for passed in (500, 1_700, 1_701, 10_000):
        frames += list(operator.handleExpiredTimer(("a",), Clock((start // 1000) + passed * 1000), None))
    found = pd.concat(frames)
    assert len(found) == n and not state.slots and not state.held and not state.parts
    assert held <= 5_000 and max(map(len, frames)) <= 1_000
    ordered = rows.sort_values(["us", "event_id"])
    assert found["event_id"].tolist() == ordered["event_id"].tolist()
    us = ordered["us"].to_numpy()
    assert found["request_rate"].tolist() == (np.arange(1, n + 1) - np.searchsorted(us, us - 60_000_000, side="right")).tolist()
    assert found["url_diversity"].tolist() == np.cumsum(~ordered["url"].duplicated()).tolist()
    assert np.allclose(found["error_rate"], ordered["error"].rolling(10, min_periods=1).mean())


def many_sources(n=6_000, sources=40):
    """Requests of several sources, one of them without a name, and the time they begin at."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(9)
    start = int(START.timestamp() * 1e6)
    names = np.array([None, *(f"ip{i}" for i in range(1, sources))], dtype=object)
    rows = pd.DataFrame({
        "event_id": np.arange(n), "source_ip": names[rng.integers(0, sources, n)], "us": start + rng.integers(0, 1_800_000_000, n),
        "url": [f"/{u}" for u in rng.integers(0, 60, n)], "error": rng.integers(0, 2, n), "status": rng.choice([200, 404, 500], n), "rt": rng.random(n),
        "size": rng.integers(0, 900, n), "method": rng.choice(["GET", "POST", "PUT"], n), "agent": rng.choice(["bot/1", "curl", "x"], n),
        "hour_of_day": 1, "day_of_week": 2})
    return rows, start


def handed_on(operator, state, rows, start):
    """All rows of one key, in three deliveries, as they leave the state at three times."""
    import pandas as pd

    operator.init(state)
    for k in range(3):
        list(operator.handleInputRows((7,), iter([rows.iloc[k::3]]), None))
    out = []
    for seconds in (600, 601, 5_000):
        out += list(operator.handleExpiredTimer((7,), Clock(start // 1000 + seconds * 1000), None))
    return pd.concat(out).set_index("event_id").sort_index()


@pytest.mark.parametrize("packed", [5, 1_000])  # URLs kept one by one, or together
def test_a_key_holds_many_sources(spark, monkeypatch, packed):
    """Each source of a key has the features of its own requests alone."""
    import numpy as np

    monkeypatch.setattr(stateful, "PACKED_URLS", packed)
    rows, start = many_sources()
    basic, state = stateful.RollingFeatures(None), Memory()
    found = handed_on(basic, state, rows, start)
    model = handed_on(stateful.RollingModelFeatures(20, None), Memory(), rows, start)
    assert len(found) == len(model) == len(rows) and bool(state.urls) == (packed == 5) and len(state.sources) == 40
    for source, own in rows.sort_values(["us", "event_id"]).groupby("source_ip", dropna=False):
        here, there, us = found.loc[own["event_id"]], model.loc[own["event_id"]], own["us"].to_numpy()
        assert here["source_ip"].isna().all() if source != source else (here["source_ip"] == source).all()
        for seconds, column in ((60, here["request_rate"]), (60, there["request_rate"]), (10, there["burst_rate"])):
            assert column.tolist() == (np.arange(1, len(us) + 1) - np.searchsorted(us, us - seconds * 1_000_000, side="right")).tolist()
        assert here["url_diversity"].tolist() == there["url_diversity"].tolist() == np.cumsum(~own["url"].duplicated()).tolist()
        assert np.allclose(here["error_rate"], own["error"].rolling(10, min_periods=1).mean())
        assert np.allclose(there["std_response_time"], own["rt"].rolling(20, min_periods=1).std(ddof=0))
        assert there["total_bytes"].tolist() == own["size"].rolling(20, min_periods=1).sum().tolist()
        methods = own["method"].tolist()
        assert there["method_diversity"].tolist() == [len(set(methods[max(0, i - 19) : i + 1])) for i in range(len(methods))]


@pytest.mark.parametrize("packed", [5, 1_000])
def test_urls_of_many_sources_are_forgotten(spark, monkeypatch, packed):
    import pandas as pd

    monkeypatch.setattr(stateful, "PACKED_URLS", packed)
    start, hour = int(START.timestamp() * 1e6), 3_600_000_000
    operator, state = stateful.RollingFeatures(hour // 1000), Memory()
    operator.init(state)
    counts = []
    for turn, at in enumerate((0, hour // 2, 2 * hour)):  # ten URLs; one of them again; after an hour and a half a new one
        urls = ([f"/{i}" for i in range(10)], ["/3"], ["/new"])[turn]
        rows = pd.DataFrame([(100 * turn + i, ip, start + at, url, 0, 1.0, 1, 2) for i, url in enumerate(urls) for ip in ("a", "b")],
                            columns=["event_id", "source_ip", "us", "url", "error", "rt", "hour_of_day", "day_of_week"])
        counts.append(operator.emit((7,), rows)["url_diversity"].tolist())
    assert counts == [[i // 2 + 1 for i in range(20)], [10, 10], [1, 1]] and len(state.urls) in (0, 2)


def test_cooldown_of_many_sources(spark):
    rows, start = many_sources()
    alerts = rows[["event_id", "source_ip", "us"]]
    kept = handed_on(stateful.Cooldown(60_000_000, "event_id bigint, source_ip string, us bigint"), Memory(), alerts, start)
    expected = set()
    for _, own in alerts.sort_values(["us", "event_id"]).groupby("source_ip", dropna=False):
        last = None
        for event, us in zip(own["event_id"], own["us"]):
            if last is None or us - last >= 60_000_000:
                last = us
                expected.add(event)
    assert set(kept.index) == expected


def test_keys_do_not_grow_with_the_sources(spark):
    """What a key costs is paid a bounded number of times, however many sources there are."""
    sources = spark.range(50_000).select(F.concat(F.lit("ip"), "id").alias("source_ip"), F.lit(START).alias("event_timestamp"), F.col("id").alias("event_id"))
    sizes = [r["count"] for r in sources.groupBy(stateful.source_group()).count().collect()]
    assert len(sizes) <= stateful.GROUPS and max(sizes) < 3 * 50_000 / stateful.GROUPS
