"""Best-fit packing of documents into sequences, with certified bounds and repacking.

Pieces are dealt to groups of bounded size by a hash, and each group is packed by best-fit decreasing.
Dual-feasible functions give a lower bound on the bins of each group and of all pieces: a group that meets
its own is certified. While the whole is above its bound, bins with gaps (in certified groups only those with
large ones) give back their pieces, which are dealt to new, fewer groups and packed again; the new bins
replace the old ones if they are fewer. Rounds begin with the largest gaps and go on to smaller ones.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, mapped, written
from tidegauge.llm.token_files import crc32_ids
from tidegauge.llm.tokens import documents_ids

CAPACITY = 4096
#: Pieces of one group at most on average; what one task holds in memory, some 10 MB.
GROUP_PIECES = 100_000
#: Gaps, as parts of a sequence, over which bins are packed again in each round.
GAPS = (1 / 4, 1 / 16, 1 / 64, 0.0)


def tokenized_pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids cut only where it is longer than a sequence."""
    slim = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, offsets in documents_ids(batches, tokenizer, "text"):
            ids, size = ids.astype("<u4"), np.diff(offsets)
            pieces = -(-size // capacity)
            of = np.repeat(np.arange(len(size)), pieces)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth * capacity
            length = np.minimum(size[of] - start, capacity)
            at = offsets[of] + start
            crc = [crc32_ids(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = [rows.column(0).take(pa.array(of)), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return mapped(slim, cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that items of these sizes need at least: the best of three families of dual-feasible functions.

    Such a function f has sum f(x) <= 1 for any items x that fit one bin together, so the sum of f over all
    items bounds the bins. Taken here, with sizes x as shares of the capacity: x itself; x with items over
    1 - e counted 1 and those under e counted 0; and floor((k + 1) x) / k, or x where (k + 1) x is whole.
    """
    if not len(sizes):
        return 0
    x, n = sizes.astype(np.int64), counts.astype(np.int64)
    best = -(-int((x * n).sum()) // capacity)
    for e in np.unique(x[x <= capacity // 2]):
        best = max(best, -(-int((np.where(x > capacity - e, capacity, np.where(x < e, 0, x)) * n).sum()) // capacity))
    for k in range(1, 20):
        whole = (k + 1) * x % capacity == 0
        # In units of 1 / (k * capacity), to stay with integers.
        value = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it, gap left in that bin at the end) of each item; the fullest bin with room is taken."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    gaps: list[int] = []
    rooms: list[int] = []  # gaps that some open bin has, ascending
    of: dict[int, list[int]] = {}
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = of[room].pop()
            if not of[room]:
                del of[room], rooms[at]
        else:
            room, b = capacity, len(gaps)
            gaps.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        gaps[b] = left = room - size
        if left:
            if left not in of:
                insort(rooms, left)
                of[left] = []
            of[left].append(b)
    return bins, offsets, np.array(gaps, np.int64)[bins] if gaps else bins


_PLACED = "rid long, length long, sequence_id long, offset long, gap long, certified boolean"


def _packed(items: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    dealt = items.select("rid", "length", F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(groups)).alias("part"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid")  # the same bins whenever the task is run
        sizes = rows["length"].to_numpy()
        bins, offsets, gaps = best_fit_decreasing(sizes, capacity)
        values, counts = np.unique(sizes, return_counts=True)
        certified = int(bins.max()) + 1 == lower_bound(values, counts, capacity)
        first = (turn << 56) + (int(rows["part"].iloc[0]) << 24)
        return pd.DataFrame({"rid": rows["rid"], "length": sizes, "sequence_id": first + bins, "offset": offsets, "gap": gaps, "certified": certified})

    return dealt.groupBy("part").applyInPandas(pack, _PLACED)


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, gaps: tuple[float, ...] = GAPS) -> DataFrame:
    """(rid, sequence_id, offset) of pieces (rid long, length from 1 to capacity)."""
    full = pieces.where(F.col("length") == capacity).select(
        "rid", (F.lit(0x7F << 56) + F.col("rid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < capacity).select("rid", "length")
    sizes = rest.groupBy("length").count().toPandas()  # a row per length at most
    total = int(sizes["count"].sum())
    least = lower_bound(sizes["length"].to_numpy(), sizes["count"].to_numpy(), capacity)
    now = written(_packed(rest, max(1, -(-total // group_pieces)), 0, capacity), "packed")
    bins = _bins(now)
    for turn, part in enumerate(gaps, 1):
        if bins <= least:
            break
        # A certified group cannot use fewer bins for its pieces; its small gaps are of no use to others.
        wide = F.col("gap") > F.when(F.col("certified"), max(part, gaps[0]) * capacity).otherwise(part * capacity)
        back = now.where(wide)
        many, before = back.count(), _bins(back)
        again = written(_packed(back, max(1, -(-many // group_pieces)), turn, capacity), "repacked")
        after = _bins(again)
        if after < before:
            now, bins = written(now.where(~wide).union(again), "packed"), bins - before + after
    return full.union(now.select("rid", "sequence_id", "offset"))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    gaps: tuple[float, ...] = GAPS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Ids are those of the tokenizer file without special tokens, with the end id after each document. Only
    documents longer than `capacity` are cut. Null and empty texts are one end id. Each row of a repeated or
    null id is packed by itself. Further columns are ignored. An empty table gives no rows.
    """
    pieces = tokenized_pieces(docs, tokenizer, id_col, text_col, capacity)
    pieces = written(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    placed = pack_pieces(pieces.select("rid", "length"), capacity, group_pieces, gaps)
    return pieces.join(placed, "rid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
