"""Alert streams into the alert store and the per-source statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.store import ip_statistics, latest_per_key, merge_statistics, to_alert_store
from tidegauge.schema import CANONICAL_ALERT

STATISTICS = (
    "source_ip string, alert_count bigint, last_alert_time timestamp, last_severity string, latest_alert string"
)
#: Parts of the statistics; a micro-batch rewrites those with sources that it brings alerts of.
BUCKETS = 64
#: Versions of a part that are kept.
KEPT_VERSIONS = 3
#: Words of 64 bits of the Bloom filter of ten minutes' keys, and bits set for each: one in a hundred new keys
#: is looked up at 800,000 keys, more beyond; results stay exact.
FILTER_WORDS = 1 << 17
PROBES = 6


def parse_alerts(messages: DataFrame) -> DataFrame:
    """Topic records whose value is a canonical alert in JSON."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), CANONICAL_ALERT).alias("alert")
    ).select("alert.*")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("source_ip"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _drop(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATISTICS + ", bucket int, version bigint").parquet(f"{path}/statistics")


def _newest(versions: DataFrame) -> DataFrame:
    """The newest version of each bucket: the buckets are few, and only partition values are read to find it."""
    newest = versions.groupBy("bucket").agg(F.max("version").alias("version"))
    return versions.join(F.broadcast(newest), ["bucket", "version"])


def _slot() -> Column:
    """The ten minutes that an alert's time lies in, as yyyyMMddHHm; `none` without a time."""
    return F.coalesce(F.substring(F.date_format("alert_ts", "yyyyMMddHHmm"), 1, 11), F.lit("none")).alias("slot")


def _filter_words(rows: DataFrame) -> DataFrame:
    """(slot, rowkey, word, bit) of each key: where its PROBES bits stand in the Bloom filter of its slot."""
    bits = F.lit(FILTER_WORDS * 64)
    first, step = F.pmod(F.xxhash64("rowkey"), bits), F.pmod(F.xxhash64(F.lit(17), "rowkey"), bits)
    places = F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.pmod(first + i * step, bits))
    placed = rows.select("slot", "rowkey", F.explode(places).alias("place"))
    word, bit = F.shiftright("place", 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    return placed.select("slot", "rowkey", word.alias("word"), bit.alias("bit"))


def _folder(spark: SparkSession, path: str, name: str, slots: list[str], schema: str) -> DataFrame | None:
    """The parts of an index folder that belong to these slots; other folders are not even listed."""
    found = [f"{path}/{name}/slot={s}" for s in slots if _exists(spark, f"{path}/{name}/slot={s}")]
    return spark.read.schema(schema).option("basePath", f"{path}/{name}").parquet(*found) if found else None


def _fresh(rows: DataFrame, batch_id: int, path: str) -> DataFrame:
    """Those (slot, rowkey) of a batch that no earlier batch has stored; brings the index up to date.

    For each slot of alert time a Bloom filter of fixed size tells what is surely new. Only keys that it may hold are looked
    up in the stored keys of their slots. Filters are versioned by batch, so a replay starts from what the batch
    first found. What is read depends on the slots touched, not on what the store or the day holds.
    """
    spark = rows.sparkSession
    keys = rows.select(_slot(), "rowkey").persist()
    try:
        slots = [r.slot for r in keys.select("slot").distinct().collect()]  # the times of one batch
        words = _filter_words(keys)
        added = words.groupBy("slot", "word").agg(F.bit_or("bit").alias("bits"))
        known = keys.limit(0)
        filters = _folder(spark, path, "filters", slots, "word int, bits bigint, slot string, version bigint")
        if filters is not None:
            earlier = filters.filter(F.col("version") < batch_id)
            newest = earlier.groupBy("slot").agg(F.max("version").alias("version"))
            before = earlier.join(F.broadcast(newest), ["slot", "version"]).select("slot", "word", "bits")
            hit = F.count_if(F.coalesce("bits", F.lit(0).cast("long")).bitwiseAND(F.col("bit")) != 0)
            maybe = words.join(before, ["slot", "word"], "left").groupBy("slot", "rowkey").agg(hit.alias("hits")).filter(F.col("hits") == PROBES)
            maybe = maybe.select("slot", "rowkey").persist()
            suspects = [r.slot for r in maybe.select("slot").distinct().collect()]
            stored = _folder(spark, path, "keys", suspects, "rowkey string, slot string, batch_id bigint") if suspects else None
            if stored is not None:
                known = maybe.join(stored.filter(F.col("batch_id") < batch_id).select("slot", "rowkey").distinct(), ["slot", "rowkey"])
            added = added.union(before).groupBy("slot", "word").agg(F.bit_or("bits").alias("bits"))
        # One file a slot: a filter has FILTER_WORDS rows at most.
        _overwrite(added.repartition("slot").withColumn("version", F.lit(batch_id).cast("long")), f"{path}/filters", "slot", "version")
        _overwrite(keys.withColumn("batch_id", F.lit(batch_id).cast("long")), f"{path}/keys", "slot", "batch_id")
        for slot in slots:
            _expire(spark, f"{path}/filters/slot={slot}")
        return keys.join(known, ["slot", "rowkey"], "left_anti").select("rowkey")
    finally:
        keys.unpersist()


def _overwrite(rows: DataFrame, path: str, *parts: str) -> None:
    rows.write.partitionBy(*parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def store_batch(alerts: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch of canonical alerts; doing it again leaves the same result.

    Store rows go to alert_date=/batch_id= partitions that a replay overwrites. An alert that an earlier
    batch has stored is not counted again (see _fresh). Statistics are kept in buckets of sources; those of
    this batch's sources are written as a new version made from the newest earlier one, which a replay
    finds unchanged, and old versions are deleted.
    """
    spark = alerts.sparkSession
    rows = to_alert_store(alerts).persist()
    try:
        _overwrite(rows.withColumn("batch_id", F.lit(batch_id)), f"{path}/alerts", "alert_date", "batch_id")
        touched = [r.bucket for r in rows.select(_bucket()).distinct().collect()]  # BUCKETS at most
        if not touched:
            return
        new = _fresh(rows, batch_id, path)
        fresh = rows.join(new, "rowkey").groupBy("source_ip").agg(F.count("*").alias("fresh"))
        delta = ip_statistics(rows).alias("d").join(fresh.alias("f"), F.col("d.source_ip").eqNullSafe(F.col("f.source_ip")), "left")
        delta = delta.select("d.*", F.coalesce("fresh", F.lit(0)).alias("fresh")).withColumn("alert_count", F.col("fresh")).drop("fresh")
        if _exists(spark, f"{path}/statistics"):
            earlier = _versions(spark, path).filter(F.col("bucket").isin(touched) & (F.col("version") < batch_id))
            before = _newest(earlier).drop("bucket", "version")
        else:
            before = spark.createDataFrame([], STATISTICS)
        merged = merge_statistics(before, delta).select("*", _bucket(), F.lit(batch_id).cast("bigint").alias("version"))
        _overwrite(merged, f"{path}/statistics", "bucket", "version")
        for bucket in touched:
            _expire(spark, f"{path}/statistics/bucket={bucket}")
    finally:
        rows.unpersist()


def _expire(spark: SparkSession, path: str) -> None:
    """Delete all but the newest versions below this folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    versions = sorted(int(s.getPath().getName().partition("=")[2]) for s in found)
    for version in versions[:-KEPT_VERSIONS]:
        _drop(spark, f"{path}/version={version}")


def start_alert_store(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Store a stream of canonical alerts, or of what `prepare` makes them from in each micro-batch.

    One checkpoint belongs to one store folder.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if prepare is None:
            return store_batch(batch, batch_id, path)
        kept = batch.persist()
        try:
            store_batch(prepare(kept), batch_id, path)
        finally:
            kept.unpersist()

    writer = (
        alerts.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored alerts, one per rowkey even if two batches wrote the same key."""
    return latest_per_key(spark.read.parquet(f"{path}/alerts").drop("batch_id"))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The newest per-source statistics."""
    return _newest(_versions(spark, path)).drop("bucket", "version")
