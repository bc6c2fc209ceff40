"""Reading access logs, bounded and unbounded, into one normalised shape."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schema import LOG_FIELDS, LOG_SCHEMA, PARTITION_KEYS


def normalize_logs(raw: DataFrame) -> DataFrame:
    """Add event time, calendar fields and flags to raw log rows.

    `timestamp` text may carry `Z` or an offset; text that is no time becomes NULL and the row
    stays (see `quarantine`). Without an `event_id` the row's own content orders equal times.
    """
    logs = raw
    if "event_timestamp" not in logs.columns:
        logs = logs.withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
    if "event_id" not in logs.columns:
        logs = logs.withColumn("event_id", F.xxhash64(*LOG_FIELDS))
    return logs.select(
        "event_id",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        F.hour("event_timestamp").alias("hour"),
        F.dayofweek("event_timestamp").alias("day_of_week"),
        *[c for c in LOG_FIELDS if c != "timestamp"],
        (F.col("status_code") >= 400).cast("int").alias("is_error"),
        (F.col("method") == "GET").cast("int").alias("is_get"),
        (F.col("method") == "POST").cast("int").alias("is_post"),
        *[c for c in logs.columns if c in (*PARTITION_KEYS[:3], "source_ip_key", "kafka_timestamp")],
    )


def quarantine(raw: DataFrame, earliest: datetime | None = None, latest: datetime | None = None) -> DataFrame:
    """Raw rows whose time cannot be read or lies outside [earliest, latest), with the `reason`: unreadable or stray."""
    stamp = F.try_to_timestamp("timestamp")
    reason = F.when(stamp.isNull(), "unreadable").when(~within(stamp, earliest, latest), "stray")
    return raw.withColumn("reason", reason).filter("reason is not null")


def timed_between(logs: DataFrame, earliest: datetime | None = None, latest: datetime | None = None) -> DataFrame:
    """Normalised rows with a time in [earliest, latest); the others are those that `quarantine` lists."""
    return logs.filter(F.col("event_timestamp").isNotNull() & within(F.col("event_timestamp"), earliest, latest))


def within(stamp: Column, earliest: datetime | None, latest: datetime | None) -> Column:
    """Whether a time lies in [earliest, latest); an end that is not given bounds nothing."""
    inside = F.lit(True)
    if earliest is not None:
        inside = inside & (stamp >= F.lit(earliest))
    return inside if latest is None else inside & (stamp < F.lit(latest))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Topic records (key, value, timestamp) → raw log rows; broken JSON gives NULL fields."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), LOG_SCHEMA).alias("data"),
        F.col("key").cast("string").alias("source_ip_key"),
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("data.*", "source_ip_key", "kafka_timestamp")


def read_logs(
    spark: SparkSession,
    base: str,
    fmt: str = "json",
    sample_fraction: float = 1.0,
    limit: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Archived logs under `base`; year/month/day/hour come from partition discovery."""
    keys = "".join(f", {key} string" for key in PARTITION_KEYS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOG_SCHEMA) + keys
    raw = spark.read.format(fmt).schema(schema).load(base)
    if sample_fraction < 1.0:
        raw = raw.sample(False, sample_fraction, seed)
    if limit is not None:
        raw = raw.limit(limit)
    return raw


def hours_between(start: datetime, end: datetime) -> Column:
    """Partition predicate for [start, end]; comparing the zero-padded keys prunes folders."""
    stamp = F.concat(*[F.col(key) for key in PARTITION_KEYS])
    lower, upper = start.strftime("%Y%m%d%H"), end.strftime("%Y%m%d%H")
    return F.col("year").between(lower[:4], upper[:4]) & stamp.between(lower, upper)


def logs_between(spark: SparkSession, base: str, start: datetime, end: datetime, fmt: str = "json") -> DataFrame:
    """Archived logs of [start, end), reading only the hour folders that can hold them."""
    raw = read_logs(spark, base, fmt).filter(hours_between(start, end))
    stamp = F.try_to_timestamp("timestamp")
    return raw.filter((stamp >= F.lit(start)) & (stamp < F.lit(end)))


def read_log_stream(
    spark: SparkSession, source: str, fmt: str = "kafka", from_earliest: bool = False, **options
) -> DataFrame:
    """Unbounded raw log rows.

    kafka: `source` is the topic list, `servers` the brokers, `max_per_trigger` the rate limit.
    Any file format: `source` is a folder of raw log records.
    """
    rate = options.pop("max_per_trigger", None)
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", options.pop("servers"))
            .option("subscribe", source)
            .option("startingOffsets", "earliest" if from_earliest else "latest")
        )
        if rate:
            reader = reader.option("maxOffsetsPerTrigger", rate)
        return parse_messages(reader.options(**options).load())
    reader = spark.readStream.format(fmt).schema(LOG_SCHEMA)
    if rate:
        reader = reader.option("maxFilesPerTrigger", rate)
    return reader.options(**options).load(source)


def storage_listing(spark: SparkSession, path: str, fmt: str = "parquet", n: int | None = None) -> DataFrame:
    """Files below `path`: location, size in MB, modification time and rows; the first n by location, or all.

    The location and size come with each row as hidden columns; no column of the files is read. Records of JSON files
    are their lines.
    """
    meta = F.col("_metadata")
    files = spark.read.format("text" if fmt == "json" else fmt).option("recursiveFileLookup", "true").load(path).select(
        meta["file_path"].alias("file_path"), meta["file_size"].alias("bytes"), meta["file_modification_time"].alias("modified")
    )
    listed = files.groupBy("file_path", "bytes", "modified").agg(F.count(F.lit(1)).alias("rows"))
    listed = listed.select("file_path", (F.col("bytes") / (1024 * 1024)).alias("size_mb"), "modified", "rows")
    return listed if n is None else listed.orderBy("file_path").limit(n)
