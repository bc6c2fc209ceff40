"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Each distinct sequence of first turns is a node. Turns are ranked by range partitioning and prefixes are hashed in
blocks of turns, so that neither a very long conversation nor one that many share meets in one task. Totals over
subtrees (tree_contraction.py) give what caching each shared prefix once would save.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.skew import ordered_positions
from tidegauge.llm.frames import column, mapped, written
from tidegauge.llm.tree_contraction import subtree_totals

#: Turns of one conversation that are hashed in one task at most.
BLOCK = 10_000
#: Nodes of more children than this, and than a thousandth of the nodes, are broadcast to them: at most MOST_HOT nodes.
HOT_CHILDREN = 100
MOST_HOT = 1_000
#: Ids in one row on their way to a node's digest.
CHUNK = 500

_WORD = r"[^\x20\x09-\x0D]+"


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, digest, words): each conversation's turns in order, counted from 1.

    Null turns come first. Turns of equal number go by the digest, the SHA-256 of length of the role, colon, role and text;
    repeated rows are turns of their own. Null roles and texts are empty. Rows without a conversation id belong to none and
    are left out. Texts are hashed whole.
    """
    role = F.coalesce(column(conversations, role_col).cast("string"), F.lit(""))
    text = F.coalesce(column(conversations, text_col), F.lit(""))
    slim = conversations.select(
        column(conversations, id_col).cast("long").alias("conv_id"),
        column(conversations, turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )
    # Written first: ranges are sampled from it, and each text is to be hashed once.
    placed = ordered_positions(written(slim.where("conv_id is not null"), "digests"), "conv_id", ["turn", "digest"])
    return written(placed.select("conv_id", F.col("position").cast("long").alias("depth"), "digest", "words"), "turns")


def _block(depth: Column) -> Column:
    return F.floor((depth - 1) / BLOCK)


def rebranched(turns: DataFrame, family: int = 20, borrowed: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: (conv_id, depth, digest, words, size) and (conv_id, size).

    Conversation c takes its first h turns from conversation c - c % family (all if that has fewer, none if it is absent)
    and its own after its first h, with h = crc32 of c in decimal digits modulo `borrowed`. `size` is the number of turns then, 0 for
    a conversation without any, which only the second table has.
    """
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrowed
    base = F.col("conv_id") - F.col("conv_id") % family
    lengths = written(turns.groupBy("conv_id").agg(F.max("depth").alias("turns")), "lengths")
    bases = lengths.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    plan = lengths.select("conv_id", "turns", share.alias("h"), base.alias("base")).join(bases, "base", "left")
    taken = F.least("h", F.coalesce("base_turns", F.lit(0).cast("long")))
    plan = plan.select("conv_id", "base", "turns", "h", taken.alias("taken"), (taken + F.greatest(F.col("turns") - F.col("h"), F.lit(0).cast("long"))).alias("size"))
    plan = written(plan, "plan")
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("depth") < borrowed)).withColumnRenamed("conv_id", "base")
    lent = heads.join(plan.where("taken > 0").select("conv_id", "base", "taken", "size"), "base").where("depth <= taken")
    # The turns of one conversation meet its plan in blocks.
    spread = plan.select("conv_id", "taken", "size", F.explode(F.sequence(F.lit(0).cast("long"), _block(F.col("turns")))).alias("block"))
    own = turns.where(F.col("depth") > share).withColumn("block", _block(F.col("depth"))).join(spread, ["conv_id", "block"])
    columns = ["digest", "words", "size"]
    own = own.select("conv_id", (F.col("depth") - share + F.col("taken")).alias("depth"), *columns)
    return lent.select("conv_id", "depth", *columns).union(own), plan.select("conv_id", "size")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same two tables for conversations that keep their own turns."""
    sizes = written(turns.groupBy("conv_id").agg(F.max("depth").alias("size")), "sizes")
    spread = sizes.select("conv_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), _block(F.col("size")))).alias("block"))
    rows = turns.withColumn("block", _block(F.col("depth"))).join(spread, ["conv_id", "block"])
    return rows.select("conv_id", "depth", "digest", "words", "size"), sizes


def _prefixes(rows: DataFrame) -> DataFrame:
    """Each turn with the 128-bit name (pa, pb) of the prefix that it ends and (qa, qb) of the one before.

    A name is the exclusive-or of hashes of (place, turn), so names of long conversations are put together from
    those of their blocks.
    """
    marked = rows.select(
        "conv_id", "depth", "words", "size", _block(F.col("depth")).alias("block"), F.xxhash64("depth", "digest").alias("a"), F.xxhash64("digest", "depth").alias("b")
    )
    marked = written(marked, "marked")
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = marked.withColumn("ra", F.bit_xor("a").over(within)).withColumn("rb", F.bit_xor("b").over(within))
    blocks = marked.where(F.col("size") > BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "block", F.bit_xor("xa").over(earlier).alias("ca"), F.bit_xor("xb").over(earlier).alias("cb"))
    zero = F.lit(0).cast("long")
    whole = inside.join(carried, ["conv_id", "block"], "left")
    pa_, pb_ = F.col("ra").bitwiseXOR(F.coalesce("ca", zero)), F.col("rb").bitwiseXOR(F.coalesce("cb", zero))
    named = whole.select("conv_id", "depth", "words", "size", "a", "b", pa_.alias("pa"), pb_.alias("pb"))
    before = [F.col("pa").bitwiseXOR(F.col("a")).alias("qa"), F.col("pb").bitwiseXOR(F.col("b")).alias("qb")]
    return written(named.select("conv_id", "depth", "words", "size", "pa", "pb", *before), "prefixes")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Each node with the id and conversation of its parent; parents of very many children are broadcast."""
    kids = nodes.where("depth > 0").groupBy(F.col("qa").alias("pa"), F.col("qb").alias("pb"), (F.col("depth") - 1).alias("depth"))
    counted = written(nodes.join(kids.agg(F.count("*").alias("n_children")), ["pa", "pb", "depth"], "left"), "counted")
    many = max(HOT_CHILDREN, -(-nodes.count() // MOST_HOT))
    key = ["qa", "qb", "depth"]
    up = [F.col("pa").alias("qa"), F.col("pb").alias("qb"), (F.col("depth") + 1).alias("depth"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")]
    hot = counted.where(F.col("n_children") > many).select(*up)
    first = counted.join(F.broadcast(hot), key, "left")
    rest = first.where("parent is null").drop("parent", "parent_conv_id").join(counted.where(F.coalesce("n_children", F.lit(0)).between(1, many)).select(*up), key, "left")
    return written(first.where("parent is not null").unionByName(rest), "linked")


def _member_digests(ends: DataFrame) -> DataFrame:
    """(pa, pb, depth, ends_sha256) of (pa, pb, depth, conv_id): the hash of each node's ids, ascending, comma-joined.

    A hash of one string is read in order, but not held: range partitions put the ids into chunks, and what
    reads a node's chunks one after the other gets a row for CHUNK ids.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.cast(batch.column(3), pa.string()).to_pylist()
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
            cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            cuts = [a for s, e in zip(cuts, [*cuts[1:], len(keys)], strict=True) for a in range(s, e, CHUNK)]
            text = [",".join(ids[a:b]) for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True)]
            at = pa.array(cuts, pa.int64())
            yield pa.record_batch([*[batch.column(i).take(at) for i in range(4)], pa.array(text, pa.string())], names=["pa", "pb", "depth", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for *now, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)], strict=True):
                if now != key:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digest_rows(out)
        if state:
            yield _digest_rows([(*key, state.hexdigest())])

    order = ["pa", "pb", "depth", "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = mapped(chunks, joined, "pa long, pb long, depth long, first long, ids string")
    order[-1] = "first"
    return mapped(chunks.repartition("pa", "pb", "depth").sortWithinPartitions(*order), hashed, "pa long, pb long, depth long, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["pa", "pb", "depth", "ends_sha256"])


def prefix_trie(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations that `rebranched` or `as_they_are` give.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, words of the last turn for every member but one) and ends_sha256
    (of the ids of conversations that end there). The root stands for all conversations, also those without turns.
    No conversations give no rows.
    """
    prefixes = _prefixes(rows)
    nodes = prefixes.groupBy("pa", "pb", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.min("qa").alias("qa"), F.min("qb").alias("qb")
    )
    zero = F.lit(0).cast("long")
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("pa"), zero.alias("pb"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("words"), F.lit(None).cast("long").alias("qa"), F.lit(None).cast("long").alias("qb"))
    nodes = written(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    linked = _with_parents(nodes)
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")
    tree = linked.select("id", "parent", leaf.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    ends = prefixes.where("depth = size").select("pa", "pb", "depth", "conv_id")
    ends = ends.union(sizes.where("size = 0").select(zero, zero, zero, "conv_id"))
    out = linked.join(totals, "id").join(_member_digests(ends), ["pa", "pb", "depth"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def shared_prefixes(conversations: DataFrame, **columns: str) -> DataFrame:
    """prefix_trie of a table of conversations (conv_id, turn, role, text) as they are."""
    return prefix_trie(*as_they_are(ordered_turns(conversations, **columns)))
