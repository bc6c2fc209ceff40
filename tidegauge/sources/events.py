"""Access-log rows derived from the generic `events` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schema import LOG_FIELDS
from tidegauge.sources.logs import normalize_logs

EPOCH = "2024-01-01 00:00:00"
COMPRESSION = 600


def logs_from_events(events: DataFrame) -> DataFrame:
    """Raw log columns over events; time runs COMPRESSION times faster from EPOCH on."""
    epoch = F.unix_micros(F.lit(EPOCH).cast("timestamp"))
    elapsed = F.unix_micros(F.col("ts").cast("timestamp")) - epoch
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    errors = F.array(*[F.lit(code) for code in (404, 429, 500, 503)])
    return events.select(
        "event_id",
        F.timestamp_micros(epoch + F.floor(elapsed / COMPRESSION)).alias("event_timestamp"),
        F.concat_ws(
            ".", F.lit("10.0"), F.floor(user / 256).cast("string"), (user % 256).cast("string")
        ).alias("source_ip"),
        F.when(kind == "purchase", "POST").when(kind == "signup", "PUT").otherwise("GET").alias("method"),
        F.concat(F.lit("/"), kind, F.lit("/"), (k % 7).cast("string")).alias("url"),
        F.when(kind == "error", F.get(errors, k % 4))
        .when(k % 10 == 0, F.lit(301))
        .otherwise(F.lit(200))
        .alias("status_code"),
        (k * 100).alias("bytes_sent"),
        (F.col("value") / 20).alias("response_time"),
        F.when(k % 9 == 0, "curl/7.68.0").when(k % 9 == 1, "bot/1.0").otherwise("Mozilla/5.0").alias("user_agent"),
    )


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised logs over `events.parquet`."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return normalize_logs(logs_from_events(spark.read.parquet(f"{sf_dir}/events.parquet")))


def event_log_stream(spark: SparkSession, sf_dir: str, max_bytes: int = 8 << 30) -> DataFrame:
    """The same logs as an unbounded source, read in micro-batches of files of `max_bytes` together."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxBytesPerTrigger", str(max_bytes))
    events = stream.parquet(sf_dir)
    return normalize_logs(logs_from_events(events))


def raw_text_logs(logs: DataFrame) -> DataFrame:
    """Normalised logs back in the raw record shape with a text timestamp."""
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return logs.select(stamp.alias("timestamp"), *[c for c in LOG_FIELDS if c != "timestamp"])
