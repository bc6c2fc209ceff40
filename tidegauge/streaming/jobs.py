"""Running several streams together, progress counters and periodic retraining."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegauge.operators.ensemble import train_ensemble
from tidegauge.schema import ModelConfig


def start_all(*starters: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
    """Start every query; if one cannot start, stop the others and raise."""
    started: list[StreamingQuery] = []
    try:
        for start in starters:
            started.append(start())
    except Exception:
        stop_all(started)
        raise
    return started


def stop_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def run_until_one_ends(spark: SparkSession, queries: list[StreamingQuery], timeout: int | None = None) -> None:
    """Wait for the first query to end or fail, then stop the rest; a failure is raised."""
    try:
        spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
    finally:
        stop_all(queries)


class ProgressCounter(StreamingQueryListener):
    """Input rows and current rate per query, by query name or id."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.rate: dict[str, float] = {}

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self.rows[name] = self.rows.get(name, 0) + progress.numInputRows
        self.rate[name] = progress.processedRowsPerSecond

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counted(df: DataFrame, name: str, alert: str | None = None) -> tuple[DataFrame, Observation]:
    """`df` plus counters that fill while it runs: rows, distinct sources (approximate), alerts."""
    observation = Observation(name)
    counters = [F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("source_ip").alias("sources")]
    if alert:
        counters.append(F.count_if(F.expr(alert)).alias("alerts"))
    return df.observe(observation, *counters), observation


def start_retraining(
    features: DataFrame, path: str, checkpoint: str, cfg: ModelConfig = ModelConfig(), trigger: dict | None = None
) -> StreamingQuery:
    """Collect labelled rolling features and refit the ensemble every `retrain_every` rows over the newest `retrain_over`.

    The buffer is a folder of parts, one a micro-batch, and a manifest with each part's rows and the rows up to it.
    Parts that the newest `retrain_over` rows do not reach are deleted, so a fit reads that many rows and one part
    more however long the stream runs. A model is saved as `path`/models/version=<batch>. Everything follows from the
    manifest, so a restart or a replayed batch goes on as before. Call `fit_collected` after stopping for a last fit.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{path}/features/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(part)
        rows = spark.read.schema(batch.schema).parquet(part).count()
        manifest = _manifest(spark, path, batch_id)
        before = manifest[-1][2] if manifest else 0
        manifest.append((batch_id, rows, before + rows))
        # With this batch's rows to spare, so that a replay of it finds the same buffer.
        kept = _reaching(manifest, cfg.retrain_over + rows)
        spark.createDataFrame(kept, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch_id={batch_id}")
        _delete_others(spark, f"{path}/features", {m[0] for m in kept})
        _delete_others(spark, f"{path}/manifest", {batch_id, batch_id - 1})
        if (before + rows) // cfg.retrain_every > before // cfg.retrain_every:
            _fit(spark, path, cfg, f"version={batch_id}")

    writer = features.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(step)
    return (writer.trigger(**trigger) if trigger else writer).start()


_MANIFEST = "part bigint, rows bigint, upto bigint"


def _folders(spark: SparkSession, path: str) -> list[int]:
    """The batches that have a folder below this one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(int(s.getPath().getName().partition("=")[2]) for s in files.listStatus(folder))


def _delete_others(spark: SparkSession, path: str, kept: set[int]) -> None:
    for batch in set(_folders(spark, path)) - kept:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _manifest(spark: SparkSession, path: str, before: int | None = None) -> list[tuple[int, int, int]]:
    """(part, rows, rows up to it) of the parts held, oldest first, after the last batch or the last one `before` another."""
    batches = [b for b in _folders(spark, f"{path}/manifest") if before is None or b < before]
    if not batches:
        return []
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/batch_id={batches[-1]}").collect()
    return sorted(tuple(r) for r in rows)


def _reaching(manifest: list[tuple[int, int, int]], rows: int) -> list[tuple[int, int, int]]:
    """The newest parts that together hold so many rows, or all."""
    last = manifest[-1][2] if manifest else 0
    return [m for m in manifest if m[2] > last - rows]


def newest_collected(spark: SparkSession, path: str, rows: int) -> DataFrame | None:
    """The newest `rows` rows that a retraining has collected, in the order in which they came, then of time."""
    parts = [m for m in _reaching(_manifest(spark, path), rows) if m[1]]
    if not parts:
        return None
    table = spark.read.option("basePath", f"{path}/features").parquet(*[f"{path}/features/batch_id={m[0]}" for m in parts])
    return table.orderBy(F.desc("batch_id"), F.desc("event_timestamp"), F.desc("event_id")).limit(rows).drop("batch_id")


def _fit(spark: SparkSession, path: str, cfg: ModelConfig, name: str) -> None:
    newest = newest_collected(spark, path, cfg.retrain_over)
    model = None if newest is None else train_ensemble(newest, cfg)
    if model is not None:
        model.save(spark, f"{path}/models/{name}")


def fit_collected(spark: SparkSession, path: str, cfg: ModelConfig = ModelConfig()) -> None:
    """A last fit over the newest rows that a stopped retraining has collected, saved as `path`/models/last."""
    _fit(spark, path, cfg, "last")
