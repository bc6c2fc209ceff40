"""Alert cooldown: per source, drop alerts that follow the last kept one too closely.

Whether an alert is kept depends on the last *kept* alert, which no window frame can express.
Ordinary sources are folded in order, one task per source. The alerts of a hot source are cut
into time cells: a first pass reduces each cell to "threshold → last kept time in the cell",
folding those few rows gives the last kept time before every cell, and a second pass then
handles all cells independently.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.skew import HOT_ROWS, split_hot
from tidegauge.session import cut_lineage

# Cell length in cooldown gaps; chains that start apart have usually met after so many gaps.
CELL_GAPS = 20


def _runs(column: pa.Array) -> Iterator[tuple[object, int, int]]:
    """(value, start, end) of every run of equal values."""
    encoded = pc.run_end_encode(column)
    start = 0
    for value, end in zip(encoded.values.to_pylist(), encoded.run_ends.to_pylist()):
        yield value, start, end
        start = end


def spaced(times: np.ndarray, last: int | None, gap: int) -> tuple[np.ndarray, int | None]:
    """(mask of kept sorted times, last kept time), jumping from one kept time to the next."""
    keep = np.zeros(len(times), dtype=bool)
    at = 0
    while True:
        if last is not None:
            at += int(np.searchsorted(times[at:], last + gap))
        if at >= len(times):
            return keep, last
        keep[at], last = True, int(times[at])


def keep_spaced(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    """Filter batches sorted by (_group, _us); `_last` is the kept time before a group, if any."""
    group, last = object(), None
    for batch in batches:
        times = batch.column("_us").to_numpy()
        before = batch.column("_last")
        keep = np.zeros(len(times), dtype=bool)
        for value, start, end in _runs(batch.column("_group")):
            if value != group:
                group, last = value, before[start].as_py()
            keep[start:end], last = spaced(times[start:end], last, gap)
        yield batch.filter(pa.array(keep))


def cell_steps(times: np.ndarray, gap: int, cell_start: int) -> tuple[np.ndarray, np.ndarray]:
    """Step function of one cell: the first `entry` >= threshold gives the last kept time `leave`.

    A threshold is the kept time before the cell plus the gap, so only alerts up to the first
    one at or after cell_start + gap can be the cell's first kept alert.
    """
    n = len(times)
    step = np.searchsorted(times, times + gap)
    final = np.where(step == n, np.arange(n), np.minimum(step, n - 1))
    while True:
        further = final[final]
        if np.array_equal(further, final):
            break
        final = further
    entries = min(int(np.searchsorted(times, cell_start + gap)) + 1, n)
    leave = times[final[:entries]]
    ends = np.flatnonzero(np.append(leave[1:] != leave[:-1], True))
    return times[:entries][ends], leave[ends]


def _cells_to_steps(batches: Iterator[pa.RecordBatch], gap: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (source_ip, cell, _us) → step rows; keeps the times of one cell at most."""
    def flush(key, parts):
        entry, leave = cell_steps(np.concatenate(parts), gap, key[1] * gap * CELL_GAPS)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]] * len(entry), pa.string()),
                pa.array([key[1]] * len(entry), pa.int64()),
                pa.array(entry, pa.int64()),
                pa.array(leave, pa.int64()),
            ],
            schema=schema,
        )

    key, parts = None, []
    for batch in batches:
        times = batch.column("_us").to_numpy()
        cells = batch.column("cell").to_numpy()
        for ip, start, end in _runs(batch.column("source_ip")):
            edges = [start, *(np.flatnonzero(np.diff(cells[start:end])) + start + 1).tolist(), end]
            for lo, hi in zip(edges, edges[1:]):
                found = (ip, int(cells[lo]))
                if key is not None and found != key:
                    yield flush(key, parts)
                    parts = []
                key = found
                parts.append(times[lo:hi])
    if key is not None:
        yield flush(key, parts)


def _steps_to_starts(batches: Iterator[pa.RecordBatch], gap: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Step rows sorted by (source_ip, cell, entry) → last kept time before every cell."""
    ip, cell, threshold, last, decided = object(), None, None, None, False
    for batch in batches:
        out = []
        rows = zip(*[batch.column(c).to_pylist() for c in ("source_ip", "cell", "entry", "leave")])
        for row_ip, row_cell, entry, leave in rows:
            if row_ip != ip:
                ip, cell, last = row_ip, None, None
            if row_cell != cell:
                cell, decided = row_cell, False
                threshold = None if last is None else last + gap
                out.append((row_ip, row_cell, last))
            if not decided and (threshold is None or entry >= threshold):
                last, decided = leave, True
        yield pa.RecordBatch.from_pylist(
            [dict(zip(schema.names, r)) for r in out], schema=schema
        )


def _cooldown_hot(alerts: DataFrame, gap: int) -> DataFrame:
    """Second passes for hot sources; equal times of a source are one candidate."""
    columns = alerts.columns
    placed = alerts.withColumn("cell", F.floor(F.col("_us") / (gap * CELL_GAPS)))
    candidates = placed.groupBy("source_ip", "cell", "_us").agg(
        F.min_by(F.struct(*columns), "event_id").alias("row")
    )
    step_schema = pa.schema(
        [("source_ip", pa.string()), ("cell", pa.int64()), ("entry", pa.int64()), ("leave", pa.int64())]
    )
    steps = (
        placed.select("source_ip", "cell", "_us")
        .distinct()
        .repartition("source_ip", "cell")
        .sortWithinPartitions("source_ip", "cell", "_us")
        .mapInArrow(
            lambda batches: _cells_to_steps(batches, gap, step_schema),
            "source_ip string, cell bigint, entry bigint, leave bigint",
        )
    )
    start_schema = pa.schema([("source_ip", pa.string()), ("cell", pa.int64()), ("_last", pa.int64())])
    starts = (
        steps.repartition("source_ip")
        .sortWithinPartitions("source_ip", "cell", "entry")
        .mapInArrow(
            lambda batches: _steps_to_starts(batches, gap, start_schema),
            "source_ip string, cell bigint, _last bigint",
        )
    )
    same_cell = F.col("c.source_ip").eqNullSafe(F.col("s.source_ip")) & (F.col("c.cell") == F.col("s.cell"))
    joined = candidates.alias("c").join(starts.alias("s"), same_cell).select(
        "c.row.*", "s._last", F.concat_ws("|", "c.source_ip", "c.cell").alias("_group")
    )
    return _fold(joined, gap)


def _fold(alerts: DataFrame, gap: int) -> DataFrame:
    return (
        alerts.repartition("_group")
        .sortWithinPartitions("_group", "_us", "event_id")
        .mapInArrow(lambda batches: keep_spaced(batches, gap), alerts.schema)
        .drop("_group", "_last", "_us")
    )


def apply_cooldown(alerts: DataFrame, seconds: float = 30, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Alerts at least `seconds` after the previously kept alert of the same source.

    The alerts are written once before their sources are counted, so their lineage runs once.
    """
    gap = int(seconds * 1_000_000)
    timed = cut_lineage(alerts.withColumn("_us", F.unix_micros("event_timestamp")))
    ordinary, hot = split_hot(timed, "source_ip", hot_rows)
    kept = _fold(
        ordinary.withColumns({"_last": F.lit(None).cast("bigint"), "_group": F.col("source_ip")}), gap
    )
    return kept if hot is None else kept.unionByName(_cooldown_hot(hot, gap))
