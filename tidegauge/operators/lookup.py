"""Alerts of one source, and the newest of all, without reading the store.

The layout prunes: folders by date, in each the rows ordered by source and cut into small row groups, with a
Bloom filter of the sources beside each. Dates are visited newest first, in groups that double, until enough alerts are
found, so a look-up reads the dates that it needs and there the row groups that can hold the source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group: what a look-up reads at least of a date that holds its source.
GROUP_BYTES = 4 << 20
SHOWN = ("rowkey", "alert_ts", "source_ip", "severity", "detection_method")


def write_lookup(rows: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Write store rows to `path`/alert_date=; the dates among them are replaced, others stay.

    Range partitioning by date, source and key keeps a source together without gathering a hot one in one task: its
    rows go on in the next file. Within a source the newest come first.
    """
    order = ["alert_date", "source_ip", F.desc("rowkey")]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.partitionBy("alert_date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#source_ip", "true")
        .option("parquet.block.size", str(group_bytes))
        .parquet(path)
    )


def compact_days(spark: SparkSession, store: str, path: str, days: list) -> None:
    """Bring these dates of a streaming alert store (streaming/store.py) into the look-up layout, once they are complete."""
    from tidegauge.operators.store import latest_per_key

    rows = spark.read.parquet(f"{store}/alerts").filter(F.col("alert_date").isin(days)).drop("batch_id")
    write_lookup(latest_per_key(rows), path)


def stored_dates(spark: SparkSession, path: str) -> list[str]:
    """Date folders, newest first; alerts without a date come last."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [s.getPath().getName().partition("=") for s in files]
    dates = [value for key, _, value in names if key == "alert_date"]
    return sorted(dates, key=lambda d: (d[:1].isdigit(), d), reverse=True)


def _newest(spark: SparkSession, path: str, limit: int, wanted: Callable[[DataFrame], DataFrame], columns: tuple[str, ...]) -> DataFrame:
    dates, done, step = stored_dates(spark, path), 0, 1
    found: list[tuple] = []
    schema = None
    while len(found) < limit and done < len(dates):
        folders = [f"{path}/alert_date={d}" for d in dates[done : done + step]]
        rows = wanted(spark.read.option("basePath", path).parquet(*folders)).orderBy(F.desc("rowkey")).limit(limit - len(found)).select(*columns)
        schema = rows.schema
        found += [tuple(r) for r in rows.collect()]  # `limit` rows at most
        done, step = done + step, step * 2
    if schema is None:
        return wanted(spark.read.parquet(path)).select(*columns).limit(0)
    return spark.createDataFrame(found, schema)


def newest_of_source(spark: SparkSession, path: str, ip: str | None, limit: int = 10, columns: tuple[str, ...] = SHOWN) -> DataFrame:
    """The newest alerts of one source, at most `limit`, newest first."""
    return _newest(spark, path, limit, lambda rows: rows.filter(F.col("source_ip").isNull() if ip is None else F.col("source_ip") == ip), columns)


def newest_alerts(spark: SparkSession, path: str, limit: int = 50, columns: tuple[str, ...] = SHOWN) -> DataFrame:
    """The newest alerts of all sources, at most `limit`, newest first."""
    return _newest(spark, path, limit, lambda rows: rows, columns)


def history_of_source(spark: SparkSession, path: str, stats: DataFrame, ip: str, limit: int = 50) -> DataFrame:
    """`store.ip_history` from the look-up layout."""
    from tidegauge.operators.store import ip_history

    rows = newest_of_source(spark, path, ip, limit, ("rowkey", "alert_ts", "source_ip", "severity", "detection_method", "features", "metrics"))
    return ip_history(rows, stats, ip, limit)
