"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import scratch_path


#: Bytes of a batch of rows on its way to a Python worker, unless the session sets its own.
BATCH_BYTES = 8 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`rows.mapInArrow(run, schema)` with batches bounded in bytes, whatever the length of the texts in them."""
    spark = rows.sparkSession
    if not spark.sparkContext.getConf().contains(_BATCHES):
        spark.conf.set(_BATCHES, str(BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        # The worker may idle beside others for long: what Arrow keeps for later goes back.
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(task, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once as Parquet to the shared scratch folder and read back.

    The copy outlives a lost executor and is not computed again by later jobs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the copies that `written` made, once all that reads them has been written itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def column(df: DataFrame, name: str) -> Column:
    """The column of that exact name, also where it holds dots or back ticks."""
    return df["`" + name.replace("`", "``") + "`"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: list[str]) -> str:
    """A column name that does not clash with those of a caller's table."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free hash of all rows."""
    row = df.agg(F.count("*"), F.bit_xor(F.xxhash64(*[column(df, c) for c in df.columns]))).first()
    return row[0], row[1] or 0


def kept_rows(docs: DataFrame, keys: dict[str, Column], decided: DataFrame) -> DataFrame:
    """The rows of `docs`, with their own columns, that `decided` keeps.

    `keys` are expressions over `docs` that tell documents apart; `decided` has a row with the same keys and a
    boolean `kept` for each row of `docs`. Of rows with equal keys that are kept once, the one stays whose columns come
    first as JSON text. Only keys with rows to drop are joined.
    """
    names = list(keys)
    marks = decided.groupBy(*names).agg(F.max("kept").alias("some"), F.count("*").alias("n")).where("not some or n > 1")
    marks = marks.select(*[F.col(k).alias(f"_{k}") for k in names], "some")
    row = F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, *[c.alias(k) for k, c in keys.items()])
    same = F.lit(True)
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = rows.join(marks, same, "left")
    twins = joined.where("some").groupBy(*names).agg(F.min_by("row", F.to_json("row")).alias("row"))
    return joined.where("some is null").select("row").union(twins.select("row")).select("row.*")


def share_of(rows: DataFrame, wanted: int, *keys: str) -> DataFrame:
    """About `wanted` of the rows, by a hash of their keys; all if they are no more."""
    have = rows.count()
    if have <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64(*keys, F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * (wanted / have)))
