"""Named queries over the `events` table, with thresholds scaled so that every rule fires."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import (
    clusters,
    cooldown,
    ensemble,
    iforest,
    live,
    lookup,
    ml,
    profiles,
    report,
    response,
    rolling,
    rules,
    store,
    traffic,
    urls,
    windows,
)
from tidegauge.schema import ML_FEATURES, PARTITION_KEYS, WINDOW_V2_FEATURES, DetectionConfig
from tidegauge.session import cut_lineage, scratch_path, use_rocksdb
from tidegauge.sources import sinks
from tidegauge.sources import logs as log_source
from tidegauge.sources.events import event_log_stream, event_logs, raw_text_logs
from tidegauge.streaming import late, stateful
from tidegauge.streaming import store as stream_store
from tidegauge.streaming import windows as stream_windows
from tidegauge.streaming.drain import drain

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_CFG = DetectionConfig(request_rate=1.6, scan_rate=0.2)
RULE_CFG = DetectionConfig(request_rate=3, error_rate=0.4, response_time=4.0, scan_rate=1)
COOLDOWN_SECONDS = 120
# A source that exists at every scale factor.
WATCHED_IP = "10.0.0.7"

QUERIES: dict[str, Query] = {}


def single(df: DataFrame) -> DataFrame:
    """Doubles cut to single precision, so that the order of summation does not show."""
    return df.select(
        *[F.col(f"`{c}`").cast("float").cast("double").alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def query(name: str):
    def register(build: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return single(build(event_logs(spark, sf_dir)))

        QUERIES[name] = run
        return build

    return register


def rule_alert_rows(logs: DataFrame) -> DataFrame:
    return rules.rule_alerts(rolling.rolling_basic(logs), RULE_CFG)


def alert_store(logs: DataFrame) -> DataFrame:
    return store.to_alert_store(
        store.canonical_rule_alerts(rule_alert_rows(logs)),
        store.canonical_window_alerts(windows.windowed_alerts(logs, WINDOW_CFG)),
    )


def joined_types(column: str = "alert_types"):
    return F.array_join(column, ",")


def flat_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "event_id",
        "source_ip",
        "event_timestamp",
        joined_types_of_items().alias("alert_types"),
        "severity",
    )


def joined_types_of_items():
    return F.array_join(F.transform("alerts", lambda a: F.concat(a["type"], F.lit(":"), a["severity"])), ",")


# Source, projections, traffic ------------------------------------------------------------

query("log_view")(lambda logs: logs)
query("archive_partitions")(
    lambda logs: logs.groupBy(
        *[
            F.date_format("event_timestamp", pattern).alias(name)
            for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))
        ]
    ).agg(F.count(F.lit(1)).alias("rows"))
)
query("traffic_overview")(traffic.traffic_overview)
query("traffic_by_hour")(lambda logs: traffic.traffic_by(logs, "hour"))
query("traffic_by_dow")(lambda logs: traffic.traffic_by(logs, "day_of_week"))
query("method_distribution")(lambda logs: traffic.distribution(logs, "method"))
query("status_distribution")(lambda logs: traffic.distribution(logs, "status_code"))
query("minute_stats")(traffic.minute_stats)
query("rate_5s")(traffic.rate_series)

# Sources, URLs, response times -----------------------------------------------------------

query("ip_profile")(profiles.ip_profile)
query("suspicious_ips")(
    lambda logs: profiles.suspicious_ips(logs, 1.1, max_error_rate=0.25, error_min_requests=60)
)
query("risk_profiles")(profiles.risk_profiles)
query("high_risk_ips")(profiles.high_risk_ips)
query("top_high_risk_ips")(lambda logs: profiles.high_risk_ips(logs, top=20))
query("top_suspicious_ips")(
    lambda logs: profiles.suspicious_ips(logs, 1.1, top=20, max_error_rate=0.25, error_min_requests=60)
)
query("bot_agents")(profiles.bot_agents)
query("url_stats")(urls.url_stats)
query("top_urls")(lambda logs: urls.url_stats(logs, top=20))
query("scanned_urls")(lambda logs: urls.scanned_urls(logs, min_ratio=0.25))
query("response_summary")(response.response_summary)
query("response_by_hour")(response.response_by_hour)
query("slow_request_ips")(response.slow_request_ips)
query("top_slow_request_ips")(lambda logs: response.slow_request_ips(logs, top=10))
query("slow_request_total")(response.slow_request_total)
query("response_histogram")(lambda logs: response.histogram(logs, "response_time"))

# Windows ---------------------------------------------------------------------------------

query("windowed_stats")(windows.windowed_stats)


@query("windowed_alerts")
def windowed_alerts(logs: DataFrame) -> DataFrame:
    return windows.windowed_alerts(logs, WINDOW_CFG).withColumn("alert_types", joined_types())


@query("alert_payload")
def alert_payload(logs: DataFrame) -> DataFrame:
    """The published JSON, read back field by field."""
    alerts = windows.windowed_alerts(logs, WINDOW_CFG)
    published = rules.alert_payload(alerts, stamp=F.col("window_end"))
    field = lambda path: F.get_json_object("value", f"$.{path}")
    return published.select(
        "key",
        field("severity").alias("severity"),
        field("detection_method").alias("detection_method"),
        field("alert_types[0]").alias("first_type"),
        F.to_timestamp(field("window_start")).alias("window_start"),
        field("metrics.request_count").cast("bigint").alias("request_count"),
        field("metrics.error_rate").cast("double").alias("error_rate"),
        field("metrics.url_diversity").cast("bigint").alias("url_diversity"),
    )


query("attack_windows")(lambda logs: windows.attack_windows(logs, 8, 2, 2.5))
query("top_attack_windows")(lambda logs: windows.attack_windows(logs, 8, 2, 2.5, top=20))


def labelled_windows(logs: DataFrame) -> DataFrame:
    """Window features with a label that has both classes on this table: n > 5 and errors > 0.3."""
    return windows.window_features_v1(logs, min_rate=1.0, min_error_rate=0.3)


query("window_features_v1")(labelled_windows)
query("window_features_v2")(windows.window_features_v2)
query("class_balance")(lambda logs: windows.class_balance(labelled_windows(logs)))
query("url_entropy")(windows.url_entropy)

# Rolling features and rule alerts --------------------------------------------------------

query("rolling_basic")(rolling.rolling_basic)
query("rolling_ml")(rolling.rolling_ml)
query("pseudo_labels")(
    lambda logs: rolling.pseudo_labels(rolling.rolling_ml(logs), 3, 0.4, 2).select("event_id", "is_attack")
)
query("rule_alerts")(lambda logs: flat_alerts(rule_alert_rows(logs)))
query("cooldown_alerts")(
    lambda logs: flat_alerts(cooldown.apply_cooldown(rule_alert_rows(logs), COOLDOWN_SECONDS))
)
query("alert_display")(
    lambda logs: live.alert_display(rule_alert_rows(logs)).drop("message")
)
query("window_alert_display")(
    lambda logs: live.window_alert_display(
        windows.windowed_alerts(logs, WINDOW_CFG), stamp=F.col("window_end")
    ).withColumn("alert_types", joined_types())
)

# Alert store and report ------------------------------------------------------------------


@query("alert_store")
def stored_alerts(logs: DataFrame) -> DataFrame:
    return alert_store(logs).select(
        "rowkey", "alert_ts", "source_ip", "severity", "detection_method", joined_types().alias("alert_types")
    )


query("ip_statistics")(lambda logs: store.ip_statistics(alert_store(logs)).drop("latest_alert"))
query("alerts_by_ip")(lambda logs: store.alerts_by_ip(alert_store(logs), WATCHED_IP))
query("recent_alerts")(lambda logs: store.recent_alerts(alert_store(logs)))
query("trends_severity")(lambda logs: store.alert_trends(alert_store(logs), "severity"))
query("trends_method")(lambda logs: store.alert_trends(alert_store(logs), "method"))
query("trends_hour")(lambda logs: store.alert_trends(alert_store(logs), "hour"))
query("trends_24_hours")(lambda logs: store.alert_trends(alert_store(logs), "hour", hours=24))
query("top_offenders")(lambda logs: store.top_offenders(store.ip_statistics(alert_store(logs))))


def stored_once(logs: DataFrame) -> DataFrame:
    """The alert store as a written table, for reports that read it more than once."""
    return cut_lineage(alert_store(logs))


@query("merged_statistics")
def merged_statistics(logs: DataFrame) -> DataFrame:
    """Statistics of the first hour brought up to date with the alerts after it."""
    stored = stored_once(logs)
    first = F.col("alert_ts") < F.lit("2024-01-01 01:00:00").cast("timestamp")
    return store.merge_statistics(
        store.ip_statistics(stored.filter(first)), store.ip_statistics(stored.filter(~first))
    ).drop("latest_alert")


@query("ip_history")
def ip_history(logs: DataFrame) -> DataFrame:
    stored = stored_once(logs)
    return store.ip_history(stored, store.ip_statistics(stored), WATCHED_IP)


@query("threat_report")
def threat_report(logs: DataFrame) -> DataFrame:
    stored = stored_once(logs)
    return report.threat_report(stored, store.ip_statistics(stored))


def looked_up(logs: DataFrame) -> tuple[DataFrame, str]:
    """The alert store, and the folder of its look-up layout."""
    stored, path = stored_once(logs), scratch_path(logs.sparkSession, "lookup")
    lookup.write_lookup(stored, path)
    return stored, path


query("lookup_by_ip")(lambda logs: lookup.newest_of_source(logs.sparkSession, looked_up(logs)[1], WATCHED_IP))
query("lookup_recent")(lambda logs: lookup.newest_alerts(logs.sparkSession, looked_up(logs)[1], columns=lookup.SHOWN[1:]))


@query("lookup_history")
def lookup_history(logs: DataFrame) -> DataFrame:
    stored, path = looked_up(logs)
    return lookup.history_of_source(logs.sparkSession, path, store.ip_statistics(stored), WATCHED_IP)


# Files, archive, unusable rows -----------------------------------------------------------

FIRST_TIME = datetime(2020, 1, 1)


def spoiled(logs: DataFrame) -> DataFrame:
    """Raw rows, some of which have a text that is no time, or a time long before the others."""
    raw = raw_text_logs(logs.withColumn("user_agent", F.col("event_id").cast("string")))
    event = F.col("user_agent").cast("bigint")
    stamp = F.when(event % 97 == 5, "yesterday").when(event % 89 == 7, "1999-01-01T00:00:00").otherwise(F.col("timestamp"))
    return raw.withColumn("timestamp", stamp)


@query("quarantine_rows")
def quarantine_rows(logs: DataFrame) -> DataFrame:
    bad = log_source.quarantine(spoiled(logs), FIRST_TIME)
    return bad.select(F.col("user_agent").cast("bigint").alias("event_id"), "timestamp", "reason")


@query("archive_read")
def archive_read(logs: DataFrame) -> DataFrame:
    """Logs written to the archive's hour folders, and those of a stretch of time read back from them."""
    spark, path = logs.sparkSession, scratch_path(logs.sparkSession, "archive")
    sinks.archive(raw_text_logs(logs), path)
    some = log_source.logs_between(spark, path, datetime(2024, 1, 1, 0, 10), datetime(2024, 1, 1, 1, 5), "parquet")
    return some.groupBy(*PARTITION_KEYS).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes_sent").alias("total_bytes"), F.countDistinct("source_ip").alias("sources")
    )


TABLES = tuple("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())


def _storage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table by the listing of its files."""
    tables = None
    for name in TABLES:
        files = log_source.storage_listing(spark, f"{sf_dir}/{name}.parquet")
        rows = files.agg(F.lit(name).alias("table_name"), F.sum("rows").alias("rows"), (F.min("size_mb") > 0).alias("with_size"))
        tables = rows if tables is None else tables.unionByName(rows)
    return tables


QUERIES["storage_listing"] = _storage_listing


# Monitoring ------------------------------------------------------------------------------

query("timeline")(
    lambda logs: traffic.timeline(logs, windows.windowed_alerts(logs, WINDOW_CFG), alert_time="window_end")
)
query("threat_scores")(live.threat_scores)
query("suspicious_scores")(lambda logs: live.suspicious_scores(live.threat_scores(logs, 25, 75, 2.6)))
query("top_suspicious_scores")(lambda logs: live.suspicious_scores(live.threat_scores(logs, 25, 75, 2.6), 10))
query("top_sources")(live.top_sources)
query("normal_ips")(live.normal_ips)
query("score_histogram")(lambda logs: live.score_histogram(live.threat_scores(logs)))
query("top_urls_share")(live.top_share)
query("traffic_intensity")(live.traffic_intensity)
query("threat_level")(live.threat_level)
query("attack_rate")(lambda logs: live.attack_rate(logs, windows.attack_windows(logs, 8, 2, 2.5)))
query("capture_stats")(lambda logs: live.capture_stats(logs, ip="0.1", status_class="4xx"))
query("log_display")(live.log_display)

# Models ----------------------------------------------------------------------------------

query("scaled_features")(lambda logs: ml.z_scores(windows.window_features_v2(logs)))


@query("kmeans_clusters")
def kmeans_clusters(logs: DataFrame) -> DataFrame:
    features = labelled_windows(logs)
    scored = ml.score(ml.fit_kmeans(features), features)
    return scored.select("window_start", "source_ip", "cluster")


@query("bisecting_clusters")
def bisecting_clusters(logs: DataFrame) -> DataFrame:
    features = labelled_windows(logs)
    scored = ml.score(ml.fit_bisecting(features), features)
    return scored.select("window_start", "source_ip", "cluster")


@query("cluster_distribution")
def cluster_distribution(logs: DataFrame) -> DataFrame:
    features = labelled_windows(logs)
    return ml.cluster_distribution(ml.score(ml.fit_kmeans(features), features))


def clustered_v2(logs: DataFrame) -> DataFrame:
    features = windows.window_features_v2(logs)
    return ml.score(ml.fit_kmeans(features, WINDOW_V2_FEATURES, k=3), features)


query("cluster_profile")(lambda logs: ml.cluster_profile(clustered_v2(logs)))
query("anomaly_clusters")(lambda logs: ml.anomaly_clusters(clustered_v2(logs), max_rpm=1.2))


def scored_test_rows(logs: DataFrame, fit) -> DataFrame:
    """Hold-out rows of the labelled windows with the model's vote."""
    train, test = ml.split(labelled_windows(logs))
    return ml.score(fit(train), test)


SCORED = ("window_start", "source_ip", "is_attack", "prediction", "attack_probability")
query("rf_scores")(lambda logs: scored_test_rows(logs, ml.fit_random_forest).select(*SCORED))
query("gbt_scores")(lambda logs: scored_test_rows(logs, ml.fit_boosting).select(*SCORED))
query("rf_metrics")(
    lambda logs: ml.classification_metrics(ml.confusion(scored_test_rows(logs, ml.fit_random_forest)))
)


@query("batch_predictions")
def batch_predictions(logs: DataFrame) -> DataFrame:
    """Train, save, load and score: the model takes the round trip through storage."""
    spark = logs.sparkSession
    path = scratch_path(spark, "models")
    model = ml.fit_kmeans(windows.window_features_v2(logs), WINDOW_V2_FEATURES, k=3)
    ml.save_model(spark, model, path, "kmeans", WINDOW_V2_FEATURES)
    predictions = f"{path}/predictions"
    ml.write_predictions(ml.batch_predict(path, "kmeans", logs), predictions)
    return spark.read.parquet(predictions)


# What models hand on, checked with predictions and scores that a rule gives.


@query("metrics_of_rule")
def metrics_of_rule(logs: DataFrame) -> DataFrame:
    predicted = labelled_windows(logs).withColumn("prediction", (F.col("error_rate") > 0.4).cast("double"))
    return ml.classification_metrics(ml.confusion(predicted))


@query("profile_of_rule")
def profile_of_rule(logs: DataFrame) -> DataFrame:
    cluster = (F.col("request_count") > 5).cast("int") + 2 * (F.col("error_rate") > 0.3).cast("int")
    return ml.cluster_profile(windows.window_features_v2(logs).withColumn("cluster", cluster), 1.2)


@query("votes_of_scores")
def votes_of_scores(logs: DataFrame) -> DataFrame:
    scored = rolling.rolling_ml(logs).withColumns(
        {
            "cluster": F.lit(0),
            "distance": F.col("avg_response_time"),
            "decision": 0.2 - F.col("error_rate"),
            "vote": (F.col("burst_rate") > 1).cast("double"),
            "attack_probability": F.col("get_ratio"),
        }
    )
    return ensemble.ensemble_alerts(scored, threshold=3.5).select(
        "event_id", joined_types_of_items().alias("alert_types"), "confidence", "models_used"
    )


@query("model_round_trip")
def model_round_trip(logs: DataFrame) -> DataFrame:
    """Windows that a saved and loaded model puts into another cluster than the model itself."""
    features = cut_lineage(windows.window_features_v2(logs))
    path = scratch_path(logs.sparkSession, "models")
    model = ml.fit_kmeans(features, WINDOW_V2_FEATURES, k=3)
    ml.save_model(logs.sparkSession, model, path, "kmeans", WINDOW_V2_FEATURES)
    keys = ["source_ip", "window_start"]
    before, after = (ml.score(m, features).select(*keys, "cluster") for m in (model, ml.load_model(path, "kmeans")))
    both = before.join(after.withColumnRenamed("cluster", "loaded"), keys)
    return both.agg(F.count("*").alias("windows"), F.count_if(F.col("cluster") != F.col("loaded")).alias("moved"))


# Centres of groups that a rule makes: what a table of stored centres would hold.
Z_NAMES = tuple(f"z_{c}" for c in WINDOW_V2_FEATURES)


def assigned_windows(logs: DataFrame) -> DataFrame:
    """Scaled windows, each with the nearest of the centres of four groups and the distance to it."""
    features = cut_lineage(windows.window_features_v2(logs))
    group = (F.col("request_count") > 5).cast("int") + 2 * (F.col("error_rate") > 0.3).cast("int")
    points = cut_lineage(ml.z_scores(features).join(features.select("source_ip", "window_start", group.alias("group")), ["source_ip", "window_start"]))
    return clusters.assign(points, clusters.centres_of_groups(points, Z_NAMES, F.col("group")), Z_NAMES)


query("cluster_assignment")(lambda logs: assigned_windows(logs).select("source_ip", "window_start", "cluster", "distance"))
query("outlier_distance")(
    lambda logs: clusters.outliers(assigned_windows(logs), 4.0).select("source_ip", "window_start", "cluster", "distance", "confidence")
)
query("silhouette_by_cluster")(lambda logs: clusters.silhouette_by_cluster(cut_lineage(assigned_windows(logs)), Z_NAMES))

RULE_TREES, RULE_DEPTH = 10, 4


def rule_forest(features: DataFrame) -> pd.DataFrame:
    """Nodes of complete trees whose splits follow from tree and node numbers and the features' ranges."""
    ends = features.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in ML_FEATURES], *[F.max(c).cast("double").alias(f"hi_{c}") for c in ML_FEATURES]).first()
    rows = []
    for tree in range(RULE_TREES):
        for node in range(2 ** (RULE_DEPTH + 1) - 1):
            if node < 2**RULE_DEPTH - 1:
                feature = (tree * 7 + node * 5) % len(ML_FEATURES)
                lo, hi = ends[f"lo_{ML_FEATURES[feature]}"], ends[f"hi_{ML_FEATURES[feature]}"]
                rows.append((tree, node, feature, lo + (hi - lo) * (((tree * 13 + node * 29) % 97 + 1) / 98), 2 * node + 1, 2 * node + 2, 0.0))
            else:
                rows.append((tree, node, -1, 0.0, -1, -1, RULE_DEPTH + (tree % 3) * 0.5 + (node % 5) * 0.25))
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])


@query("forest_scores")
def forest_scores(logs: DataFrame) -> DataFrame:
    """A stored forest applied to all requests."""
    features = cut_lineage(rolling.rolling_ml(logs))
    scored = iforest.score_by_nodes(features, list(ML_FEATURES), rule_forest(features), 2**RULE_DEPTH)
    return scored.select("event_id", "score")


query("training_check")(lambda logs: ensemble.training_check(labelled_requests(logs)))


def labelled_requests(logs: DataFrame) -> DataFrame:
    return rolling.pseudo_labels(rolling.rolling_ml(logs), 3, 0.4, 2)


def labelled_once(logs: DataFrame) -> DataFrame:
    """Labelled requests as a written table: the fits and the scores read them, their windows are computed once."""
    return cut_lineage(labelled_requests(logs))


@query("kmeans_outliers")
def kmeans_outliers(logs: DataFrame) -> DataFrame:
    features = rolling.rolling_ml(logs)
    return ensemble.kmeans_outliers(ensemble.fit_outlier_kmeans(features), features, threshold=6.0)


@query("isolation_scores")
def isolation_scores(logs: DataFrame) -> DataFrame:
    features = rolling.rolling_ml(logs)
    forest = iforest.fit_iforest(features, list(ML_FEATURES), ensemble.KEYS)
    return forest.score(features).select(
        "event_id", "source_ip", "score", "decision", (F.col("decision") < 0).alias("is_anomaly")
    )


@query("ensemble_alerts")
def ensemble_alerts(logs: DataFrame) -> DataFrame:
    labelled = labelled_once(logs)
    scored = ensemble.score_ensemble(ensemble.fit_ensemble(labelled), labelled)
    return ensemble.ensemble_alerts(scored, threshold=6.0).select(
        "event_id", "source_ip", joined_types_of_items().alias("alert_types"), "confidence", "models_used"
    )


@query("ml_alert_store")
def ml_alert_store(logs: DataFrame) -> DataFrame:
    """Alerts of all three detectors in one store."""
    labelled = labelled_once(logs)
    scored = ensemble.score_ensemble(ensemble.fit_ensemble(labelled), labelled)
    stored = store.to_alert_store(
        store.canonical_rule_alerts(rule_alert_rows(logs)),
        store.canonical_window_alerts(windows.windowed_alerts(logs, WINDOW_CFG)),
        store.canonical_ml_alerts(ensemble.ensemble_alerts(scored, threshold=6.0)),
    )
    return stored.select("rowkey", "alert_ts", "source_ip", "severity", "detection_method", joined_types().alias("alert_types"))


# Streams ---------------------------------------------------------------------------------

ONCE = {"availableNow": True}


def stream_query(name: str):
    """`build` gets the log stream and a scratch folder and returns the finished result."""
    def register(build: Callable[[DataFrame, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_rocksdb(spark)
            return single(build(event_log_stream(spark, sf_dir), scratch_path(spark, name)))

        QUERIES[name] = run
        return build

    return register


def drained(build: Callable[[DataFrame], DataFrame], logs: DataFrame, path: str) -> DataFrame:
    """Run an append-mode stream to its very end into files and read them back."""

    def start(stream: DataFrame):
        return (
            build(stream)
            .writeStream.format("parquet")
            .option("path", f"{path}/rows")
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(**ONCE)
            .start()
        )

    drain(logs, f"{path}/end", start)
    schema = build(logs).schema
    return logs.sparkSession.read.schema(schema).parquet(f"{path}/rows")


stream_query("stream_windowed_stats")(
    lambda logs, path: drained(lambda s: stream_windows.closed_window_stats(s, WINDOW_CFG), logs, path)
)
stream_query("stream_minute_stats")(lambda logs, path: drained(stream_windows.closed_minute_stats, logs, path))


@stream_query("stream_alert_topic")
def stream_alert_topic(logs: DataFrame, path: str) -> DataFrame:
    """Update mode: the last message about every window, read back from the published JSON."""
    alerts = stream_windows.running_window_alerts(logs, WINDOW_CFG)
    query = sinks.start_alert_topic(
        alerts, f"{path}/topic", f"{path}/checkpoint", fmt="json", mode="update", trigger=ONCE
    )
    query.awaitTermination()
    field = lambda p: F.get_json_object("value", f"$.{p}")
    messages = logs.sparkSession.read.schema("key string, value string, batch_id bigint").json(f"{path}/topic")
    latest = messages.groupBy("key", field("window_start").alias("start")).agg(
        F.max_by("value", "batch_id").alias("value")
    )
    return latest.select(
        "key",
        F.to_timestamp("start").alias("window_start"),
        field("severity").alias("severity"),
        field("alert_types[0]").alias("first_type"),
        field("metrics.request_count").cast("bigint").alias("request_count"),
        field("metrics.error_rate").cast("double").alias("error_rate"),
    )


def stream_alert_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose mean equals the threshold are decided by the stream's files, read again in order."""
    use_rocksdb(spark)
    path = scratch_path(spark, "stream_alert_store")

    def alerts(found: DataFrame) -> DataFrame:
        return store.canonical_window_alerts(windows.alerts_of(found, lambda session: event_logs(session, sf_dir), WINDOW_CFG))

    def start(stream: DataFrame):
        found = stream_windows.closed_window_candidates(stream, WINDOW_CFG)
        return stream_store.start_alert_store(found, f"{path}/store", f"{path}/checkpoint", trigger=ONCE, prepare=alerts)

    drain(event_log_stream(spark, sf_dir), f"{path}/end", start)
    return single(stream_store.read_statistics(spark, f"{path}/store").drop("latest_alert"))


QUERIES["stream_alert_store"] = stream_alert_store


@stream_query("stream_archive")
def stream_archive(logs: DataFrame, path: str) -> DataFrame:
    sinks.start_archive(raw_text_logs(logs), f"{path}/raw", f"{path}/checkpoint", trigger=ONCE).awaitTermination()
    stored = logs.sparkSession.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").schema(
        "source_ip string, year string, month string, day string, hour string"
    ).parquet(f"{path}/raw")
    return stored.groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias("rows"))


stream_query("stream_rolling")(lambda logs, path: drained(stateful.rolling_stateful, logs, path))


stream_query("stream_rolling_ml")(lambda logs, path: drained(stateful.rolling_ml_stateful, logs, path))


@stream_query("stream_cooldown")
def stream_cooldown(logs: DataFrame, path: str) -> DataFrame:
    """Two chained stateful operators: rolling features, then the cooldown of the alerts."""

    def build(stream: DataFrame) -> DataFrame:
        alerts = flat_alerts(rules.rule_alerts(stateful.rolling_stateful(stream), RULE_CFG))
        return stateful.cooldown_stateful(alerts, COOLDOWN_SECONDS)

    return drained(build, logs, path)


@stream_query("stream_late_rows")
def stream_late_rows(logs: DataFrame, path: str) -> DataFrame:
    """Four deliveries, each over the whole time, so that much of the later ones is late; all rows and where they went."""
    spark = logs.sparkSession
    event = F.col("user_agent").cast("bigint")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spoiled(logs).schema)
    for part in range(4):

        def deliver(batch: DataFrame, batch_id: int, part: int = part) -> None:
            batch.write.mode("append" if batch_id else "overwrite").parquet(f"{path}/in/{part}")

        rows = spoiled(logs).filter(event % 4 == part)
        rows.writeStream.foreachBatch(deliver).option("checkpointLocation", f"{path}/cp{part}").trigger(**ONCE).start().awaitTermination()
        raw = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/in")
        late.start_split(raw, f"{path}/out", f"{path}/cp", timedelta(minutes=10), earliest=FIRST_TIME, trigger=ONCE).awaitTermination()
    parts = []
    for name in ("ontime", "late", "quarantine"):
        rows = late.read_part(spark, f"{path}/out", name)
        reason = F.col("reason") if name == "quarantine" else F.lit(None).cast("string")
        watermark = F.col("watermark") if name == "late" else F.lit(None).cast("timestamp")
        parts.append(rows.select(event.alias("event_id"), F.lit(name).alias("part"), reason.alias("reason"), watermark.alias("watermark")))
    return parts[0].union(parts[1]).union(parts[2])
