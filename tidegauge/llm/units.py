"""Verification of what collides, in units of bounded size.

Operators on pairs put classes of equal items into buckets. A bucket is laid out in units, pairs of blocks of
its members; each unit is verified by one task, which counts the links found instead of listing them, so that
large groups of near copies are neither held at once nor written out pair by pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.llm.frames import mapped, written

#: Members of one block; a unit holds at most two blocks.
BLOCK = 256
LINKS = "cid long, links long, root long"


def collisions(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(unit, table, bucket, cid, side) of the members (cid, table, bucket) that share a bucket with others.

    Of buckets with exactly the same members only the first is kept, by table and then by name. A bucket of
    more than `block` members is cut into blocks by a hash, and each pair of blocks is a unit; `side` tells the
    blocks apart. If `members` has a boolean `active`, only pairs with an active member are laid out: active
    members have blocks of their own, and units without any are not made.
    """
    if "active" not in members.columns:
        members = members.withColumn("active", F.lit(True))
    member = written(members, "buckets")
    live = member.join(_distinct_buckets(member), "bucket")
    return _laid_out(live, block).select("unit", "table", "bucket", "cid", "side")


def gathered(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(unit, table, bucket, cid, side, leader): as collisions(), but members of many buckets in common are brought together once.

    A member's leader is the smallest one that it reaches by two buckets. Members with one leader make up a unit of their own,
    of `table` -1, in which each of them is once, and whose pairs are those that share any bucket. Units of buckets are made
    where members have different leaders, and their pairs are those of different leaders. A leader's members are left to their buckets,
    each as its own leader (a negative number), if the units of the buckets hold fewer rows.
    """
    member = written(members, "buckets")
    live = written(member.join(_distinct_buckets(member), "bucket"), "live")
    leaders = live.select("cid", "active", F.col("cid").alias("leader")).distinct()
    for _ in range(2):
        least = live.join(leaders.select("cid", "leader"), "cid").groupBy("bucket").agg(F.min("leader").alias("leader"))
        leaders = live.join(least, "bucket").groupBy("cid").agg(F.max("active").alias("active"), F.min("leader").alias("leader"))
        leaders = written(leaders, "leaders")
    named = live.join(leaders.select("cid", "leader"), "cid")
    apart = named.groupBy("leader").agg(F.sum(F.ceil(F.col("n") / block)).alias("apart"))
    groups = leaders.groupBy("leader").agg(F.count("*").alias("n"), F.count_if("active").alias("awake")).where("n > 1 and awake > 0")
    groups = written(groups.join(apart, "leader").where(F.col("n") * F.ceil(F.col("n") / block) <= F.col("apart")).drop("apart"), "groups")
    together = leaders.join(groups, "leader").select("cid", "active", F.lit(-1).alias("table"), F.col("leader").alias("bucket"), "n", "awake", "leader")
    own = named.join(groups.select("leader", F.lit(True).alias("grouped")), "leader", "left")
    own = own.select("cid", "active", "table", "bucket", "n", "awake", F.when(F.col("grouped"), F.col("leader")).otherwise(-1 - F.col("cid")).alias("leader"))
    mixed = own.groupBy("bucket").agg(F.min("leader").alias("low"), F.max("leader").alias("high")).where("low < high").select("bucket")
    return _laid_out(together.unionByName(own.join(mixed, "bucket")), block).select("unit", "table", "bucket", "cid", "side", "leader")


def _distinct_buckets(member: DataFrame) -> DataFrame:
    """(bucket, n, awake) of the buckets with an active member beside others, the first of those with the same members."""
    h = F.xxhash64("cid")
    sums = member.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.count_if("active").alias("awake"),
        F.min("table").alias("table"),
        F.bit_xor(h).alias("x"),
        F.bit_xor(F.xxhash64(h)).alias("y"),
    )
    sums = sums.where("n > 1 and awake > 0")
    return sums.groupBy("n", "x", "y").agg(F.min(F.struct("table", "bucket", "awake")).alias("b")).select("n", "b.bucket", "b.awake")


def _laid_out(live: DataFrame, block: int) -> DataFrame:
    """The rows of `live`, with n and awake of their bucket, once for each unit that they are in, and the unit and side."""
    awake = F.ceil(F.col("awake") / block)
    # Both are counted in members here and in blocks from then on, so they change in one step.
    held = live.withColumns({"awake": awake, "blocks": awake + F.ceil((F.col("n") - F.col("awake")) / block)})
    draw = F.xxhash64("cid", F.lit(1))
    mine = F.when(F.col("active"), F.pmod(draw, F.col("awake"))).otherwise(F.col("awake") + F.pmod(draw, F.col("blocks") - F.col("awake")))
    # An active block meets all blocks, another one those that are active.
    others = F.when(F.col("active"), F.col("blocks")).otherwise(F.col("awake"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), others - 1))
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    return held.select(*live.columns, mine.alias("mine"), other.alias("other")).withColumns(
        {"unit": F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")), "side": side}
    )


class Unit(dict):
    """The rows of one unit: column name to a NumPy array of numbers or a list of other values."""

    def pairs(self) -> np.ndarray:
        """Which pairs (row before column) are this unit's: all of one block, or those across its two blocks."""
        side = self["side"]
        return np.triu((side[:, None] == 2) | (side[:, None] != side[None, :]), 1)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that it reaches over the edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def linked_rows(unit: Unit, a: np.ndarray, b: np.ndarray) -> dict[str, list]:
    """What a unit says of its links a-b: cid, links (linked items with their copies) and root of each member."""
    if not len(a):
        return {}
    cid, copies = unit["cid"], unit["copies"]
    links = np.bincount(a, copies[b], len(cid)) + np.bincount(b, copies[a], len(cid))
    root, hit = cid[roots(len(cid), a, b)], np.flatnonzero(np.bincount(a, minlength=len(cid)) + np.bincount(b, minlength=len(cid)))
    return {"cid": cid[hit].tolist(), "links": links[hit].astype(np.int64).tolist(), "root": root[hit].tolist()}


def _columns(batch: pa.RecordBatch) -> dict:
    return {
        f.name: batch.column(i).to_numpy() if pa.types.is_integer(f.type) else batch.column(i).to_pylist()
        for i, f in enumerate(batch.schema)
    }


def per_unit(rows: DataFrame, work: Callable[[Unit], dict[str, list]], schema: str) -> DataFrame:
    """The rows that `work` makes of each unit, whose rows are brought together in order of cid.

    Many small units share a task and a batch; a unit that spans batches is put together first.
    """
    like = rows.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(like)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([rest, now]) if rest is not None else now
            unit = now["unit"].to_numpy()
            if not len(unit):
                continue
            before = np.flatnonzero(unit != unit[-1])
            cut = int(before[-1]) + 1 if len(before) else 0
            yield done(now.slice(0, cut))
            rest = now.slice(cut)
        if rest is not None:
            yield done(rest)

    def done(table: pa.Table) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in arrow.names}
        if len(table):
            columns = _columns(table.combine_chunks().to_batches()[0])
            unit = columns["unit"]
            edges = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]]).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a > 1:
                    for name, values in work(Unit({k: v[a:b] for k, v in columns.items()})).items():
                        out[name] += values
        return pa.record_batch([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return mapped(rows.repartition("unit").sortWithinPartitions("unit", "cid"), run, schema)
