"""Helpers that keep one very frequent key from landing in a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage

# A key with more rows than this is worked on in several tasks.
HOT_ROWS = 5_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows: at most rows / hot_rows of them.

    The count combines on the map side, so the hot key itself shuffles one row per map task.
    """
    return df.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)


def split_hot(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None).

    The size check runs here: without hot keys the input goes on untouched. The hot-key list
    has at most rows / hot_rows entries, so Spark may broadcast it whenever it is below its own
    threshold and will shuffle it otherwise.
    """
    hot = hot_keys(df, key, hot_rows).withColumnRenamed(key, "_hot")
    if hot.isEmpty():
        return df, None
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(hot, is_hot, "left_anti"), df.join(hot, is_hot, "left_semi")


def ordered_positions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add `position`, the 1-based rank of a row within its key, for any key distribution.

    Range partitioning on (key, order) spreads one key over many tasks; the row's index inside
    its sorted partition plus the rows of that key in earlier partitions is its rank. The rows
    are checkpointed in between because partition numbers must not change between the two uses.
    """
    placed = cut_lineage(
        df.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_chunk", F.spark_partition_id())
    )
    runs = placed.groupBy(key, "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first")
    )
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col(key).alias("_key"),
        F.col("_chunk").alias("_run_chunk"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_offset"),
    )
    # At most one row per partition boundary plus one per key.
    return (
        placed.join(
            offsets,
            placed[key].eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_run_chunk")),
        )
        .withColumn("position", F.col("_slot") + F.col("_offset"))
        .drop("_slot", "_chunk", "_key", "_run_chunk", "_offset")
    )
