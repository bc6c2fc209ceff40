"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_scratch: list[str] = []
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidegauge", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time, adaptive execution and the state store that stateful jobs need.

    `master` is for local runs only; on a cluster leave it to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; invent one only for a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidegauge-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once to reliable storage and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name on the storage that all executors share."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process has named, once no result reads them any more."""
    deleted = 0
    while _scratch:
        target = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        deleted += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return deleted


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors keep list and map state, which needs this state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application.

    Functions that run in workers are pickled by reference, so executors have to be able to import the
    package even if it is installed on the driver alone.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidegauge-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
