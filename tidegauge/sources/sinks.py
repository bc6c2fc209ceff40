"""Writing logs and alerts: archive, topics, console, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.live import window_alert_display
from tidegauge.operators.rules import alert_payload
from tidegauge.schema import LOG_FIELDS, PARTITION_KEYS

# Date patterns of the archive's zero-padded folder names.
PARTITION_PATTERNS = ("yyyy", "MM", "dd", "HH")


def with_partition_keys(logs: DataFrame, time: str = "event_timestamp") -> DataFrame:
    return logs.withColumns(
        {key: F.date_format(time, pattern) for key, pattern in zip(PARTITION_KEYS, PARTITION_PATTERNS)}
    )


def archive_rows(raw: DataFrame) -> DataFrame:
    """Raw log fields plus year/month/day/hour; rows without a readable time belong in quarantine."""
    timed = raw.withColumn("_ts", F.try_to_timestamp("timestamp")).filter(F.col("_ts").isNotNull())
    return with_partition_keys(timed, "_ts").select(*LOG_FIELDS, *PARTITION_KEYS)


def archive(raw: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Write `path`/year=/month=/day=/hour=.

    The rebalance hint groups an hour's rows into files of the advised size and splits an hour
    that is larger than that over several tasks.
    """
    rows = archive_rows(raw).hint("rebalance", *PARTITION_KEYS)
    rows.write.partitionBy(*PARTITION_KEYS).format(fmt).mode(mode).save(path)


def _start(writer, trigger: dict | None) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_archive(
    raw: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Exactly-once archive of a raw log stream."""
    writer = (
        archive_rows(raw)
        .writeStream.partitionBy(*PARTITION_KEYS)
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _start(writer, trigger)


def start_records(
    records: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "kafka",
    mode: str = "update",
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Publish (key, value) records: `target` is a topic, or a folder for file formats."""
    writer = records.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    if fmt == "kafka":
        return _start(writer.format("kafka").option("topic", target), trigger)
    if mode == "append":
        return _start(writer.format(fmt).option("path", target), trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{target}/batch_id={batch_id}")

    return _start(writer.foreachBatch(write), trigger)


def start_alert_topic(alerts: DataFrame, target: str, checkpoint: str, **options) -> StreamingQuery:
    """Publish a stream of window alerts as JSON messages keyed by source."""
    return start_records(alert_payload(alerts), target, checkpoint, **options)


def start_alert_console(alerts: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Show a stream of window alerts on the console."""
    writer = window_alert_display(alerts).writeStream.outputMode("update").format("console").option("truncate", "false")
    return _start(writer, trigger)


def export_report(report: DataFrame, path: str) -> None:
    """Threat report as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
