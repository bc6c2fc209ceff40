"""Run a stream to its end, with its last windows and held rows.

A watermark follows the latest row, so what lies within its delay waits for later rows. A finished stream gets
one: a row far in the future, read in a second run over the same checkpoint, after all others.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

#: Later than all rows, and still a time that pandas can hold.
END = datetime(2200, 1, 1)


def drain(
    logs: DataFrame, folder: str, start: Callable[[DataFrame], StreamingQuery], time_col: str = "event_timestamp"
) -> None:
    """Start the query over `logs` until it has read all, then once more with an end mark.

    `start` is called twice and must build the same query with an availableNow trigger and one checkpoint.
    `folder` is a new folder for the mark. The mark is null but for its time; its own window stays open.
    """
    spark = logs.sparkSession
    spark.createDataFrame([], logs.schema).write.parquet(folder)
    both = logs.unionByName(spark.readStream.schema(logs.schema).parquet(folder))
    start(both).awaitTermination()
    mark = [tuple(END if f.name == time_col else None for f in logs.schema)]
    spark.createDataFrame(mark, _nullable(logs)).write.mode("append").parquet(folder)
    start(both).awaitTermination()


def _nullable(df: DataFrame):
    schema = df.schema
    for field in schema:
        field.nullable = True
    return schema
