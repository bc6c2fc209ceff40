"""What a stream cannot use, beside what it can: unreadable, stray and late rows, in one query with the rows on time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.sources.logs import quarantine, within


def _latest(spark: SparkSession, path: str, batch: int) -> datetime | None:
    """The latest time of all batches up to this one; none before the first."""
    return spark.read.schema("latest timestamp").parquet(f"{path}/seen/batch_id={batch}").first().latest if batch >= 0 else None


def split_batch(
    raw: DataFrame,
    batch_id: int,
    path: str,
    delay: timedelta,
    in_force: int = 1,
    earliest: datetime | None = None,
    latest: datetime | None = None,
) -> None:
    """Write one micro-batch of raw rows to `path`/ontime, /late and /quarantine, each under batch_id=.

    A row is late if its time is not after the watermark, the latest time of the batches up to `in_force` before this
    one less `delay`. Spark's stateful operators drop what is late by the times of two batches before: in_force=2
    lists exactly the rows that they drop. Rows without a readable time, or with one outside [earliest, latest), go to
    quarantine with the reason and move no watermark. A replayed batch overwrites what it wrote.
    """
    spark = raw.sparkSession
    kept = raw.persist()
    try:
        known = _latest(spark, path, batch_id - in_force)
        stamp = F.try_to_timestamp("timestamp")
        bad = quarantine(kept, earliest, latest)
        good = kept.filter(stamp.isNotNull() & within(stamp, earliest, latest))
        watermark = F.lit(None if known is None else known - delay).cast("timestamp")
        is_late = F.coalesce(stamp <= watermark, F.lit(False))
        parts = {"ontime": good.filter(~is_late), "late": good.filter(is_late).withColumn("watermark", watermark), "quarantine": bad}
        for name, rows in parts.items():
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        before = _latest(spark, path, batch_id - 1)
        newest = good.agg(F.greatest(F.max(stamp), F.lit(before).cast("timestamp")).alias("latest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")
    finally:
        kept.unpersist()


def start_split(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    delay: timedelta = timedelta(minutes=10),
    in_force: int = 1,
    earliest: datetime | None = None,
    latest: datetime | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Split a stream of raw log rows (see split_batch); one checkpoint belongs to one folder."""
    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: split_batch(batch, batch_id, path, delay, in_force, earliest, latest)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_part(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows written as `ontime`, `late` or `quarantine` so far."""
    return spark.read.parquet(f"{path}/{name}")
