"""Jaccard self-join on word shingles by a MinHash LSH forest.

Each tree of the forest is a prefix trie over its own part of the signatures. The search starts at the longest prefixes:
texts that share one in some tree are candidates, which are verified exactly. Prefixes are then shortened step by step,
for each text by what was found for it: a text is done once all its links are so similar that prefixes of that length
meet such pairs with the target recall. Texts without links, or with a link nearer to the threshold, go on, and meet all
texts, down to the length at which a pair at the threshold itself is met with the target recall. So a large group of alike
texts ends its own search early and nobody else's. Equal texts are one class throughout, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import connected_components
from tidegauge.llm.frames import column, forget, kept_rows, mapped, written
from tidegauge.llm.minhash import (
    BUCKETS,
    THRESHOLD,
    bucket_keys,
    bucket_rows,
    shingles,
    signatures,
    slices_of,
    verified,
)
from tidegauge.llm.units import Unit, gathered

TREES = 18
DEPTH = 7
RECALL = 0.995


def met(similarity, depth: int, trees: int = TREES):
    """Probability that two texts share a prefix of `depth` values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def sure_at(depth: int, recall: float, trees: int) -> float:
    """The similarity from which on pairs are met at this depth with probability `recall`."""
    return (1 - (1 - recall) ** (1 / trees)) ** (1 / depth)


def last_depth(threshold: float, recall: float, trees: int, depth: int) -> int:
    """The longest prefix, of at most `depth` values, that meets a pair at the threshold with probability `recall`; at least 1."""
    return next((d for d in range(depth, 1, -1) if met(threshold, d, trees) >= recall), 1)


def _signed(rows: DataFrame, trees: int, depth: int) -> DataFrame:
    """id, digest and signature (bytes; null without words) of each (id, text)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices_of(batches, "text"):
            hashes, offsets = shingles(texts)
            # 16 bits of each value do to tell prefixes apart; who collides by them is verified.
            signed = signatures(hashes, offsets, trees * depth).astype(np.uint16)
            words = np.diff(offsets) > 0
            data = [s.tobytes() if w else None for s, w in zip(signed, words, strict=True)]
            yield pa.record_batch([part.column(0), part.column(1), pa.array(data, pa.binary())], names=["id", "digest", "signature"])

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows.select("id", "digest", "text"), sign, f"id {kind}, digest binary, signature binary")


def _sets(rows: DataFrame) -> DataFrame:
    """cid, copies, signature and set of shingles of each (cid, copies, signature, text)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices_of(batches, "text"):
            hashes, offsets = shingles(texts)
            data = [np.unique(hashes[a:b]).tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.record_batch([*part.columns[:3], pa.array(data, pa.binary())], names=["cid", "copies", "signature", "shingles"])

    return mapped(rows.select("cid", "copies", "signature", "text"), gather, "cid long, copies long, signature binary, shingles binary")


def _prefixes(signed: list[bytes], trees: int, depth: int, now: int) -> np.ndarray:
    signature = np.stack([np.frombuffer(s, np.uint16) for s in signed]).reshape(-1, trees, depth)
    return bucket_keys(signature, now)


def _buckets(classes: DataFrame, trees: int, depth: int, now: int) -> DataFrame:
    """The tries' nodes at depth `now` that each class (cid, signature, active) stands under."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                nodes = bucket_rows(batch.column(0).to_numpy(), _prefixes(batch.column(1).to_pylist(), trees, depth, now))
                active = np.repeat(batch.column(2).to_numpy(zero_copy_only=False), trees)
                yield pa.record_batch([*nodes.columns, pa.array(active)], names=[*nodes.schema.names, "active"])

    return mapped(classes.select("cid", "signature", "active"), spread, f"{BUCKETS}, active boolean")


def _collected(docs: DataFrame, classes: DataFrame, trees: int, depth: int, last: int) -> DataFrame:
    """Sets of shingles of the classes that share a prefix of the shortest length: all that a longer one brings together, too."""
    nodes = _buckets(classes.withColumn("active", F.lit(True)), trees, depth, last)
    shared = nodes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    needed = nodes.join(shared.select("bucket"), "bucket").select("cid").distinct().join(classes, "cid")
    texts = docs.join(
        needed.select("cid", "copies", "signature", F.col("id").alias("wanted"), F.col("digest").alias("sought")),
        F.col("id").eqNullSafe(F.col("wanted")) & (F.col("digest") == F.col("sought")),
    )
    return written(_sets(texts).dropDuplicates(["cid"]), "sets")


def _links(docs: DataFrame, classes: DataFrame, threshold: float, recall: float, trees: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Verified links, and (cid, depth) of the classes whose search ended before the last depth."""
    worded = classes.where("signature is not null")
    last = last_depth(threshold, recall, trees, depth)
    payload = _collected(docs, worded, trees, depth, last)
    # Only what shares a short prefix can share a longer one.
    able = payload.select("cid", "copies", "signature").withColumn("active", F.lit(True))
    links, done = [], []
    for now in range(depth, last - 1, -1):
        units = written(gathered(_buckets(able, trees, depth, now)), "units")

        def buckets_of(unit: Unit, now: int = now) -> tuple[np.ndarray, np.ndarray]:
            keys = _prefixes(unit["signature"], trees, depth, now)
            return keys, _prefixes(unit["signature"], trees, depth, now + 1) if now < depth else keys[:, :0]

        sets = payload.join(able.select("cid", "active"), "cid")
        links.append(written(verified(units, sets, threshold, buckets_of), "links"))
        if now == last:
            break
        # A class is done if it has links, all of them surely met at this depth.
        found = reduce(DataFrame.unionByName, links).groupBy("cid").agg(F.min("low").alias("low"))
        goes_on = F.coalesce(F.col("low") < sure_at(now, recall, trees), F.lit(True))
        after = able.join(found, "cid", "left").select("cid", "copies", "signature", (F.col("active") & goes_on).alias("goes_on"), "active")
        after = written(after, "active")
        done.append(after.where("active and not goes_on").select("cid", F.lit(now).alias("depth")))
        able = after.select("cid", "copies", "signature", F.col("goes_on").alias("active"))
        forget(units)
    ended = reduce(DataFrame.unionByName, done) if done else able.select("cid", F.lit(last).alias("depth")).limit(0)
    return reduce(DataFrame.unionByName, links), ended


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    trees: int = TREES,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row: doc_id, text_class, class_rows, n_links, class_id, kept, depth.

    Two texts are linked if the Jaccard similarity of their sets of five-word shingles is `threshold` or more.
    `text_class` names the group of equal texts, of which there are `class_rows`; `n_links` counts all rows
    linked directly, copies included; `class_id` is the smallest id reachable by links and `kept` marks one
    row with that id. Rows with null, empty or blank text link with nothing. Texts of fewer than five
    words are one shingle. `depth` is the length of prefix at which the search for a text ended (null without words). A link between
    two texts whose other links are all much stronger may be met with the probability of that depth only. Null ids take part; a group of null ids only has a null class_id. Repeated rows are
    copies. Texts are read whole. Further columns are ignored. An empty table gives no rows.
    """
    found = _joined(docs, id_col, text_col, threshold, recall, trees, depth)
    return found.select(F.col("id").alias("doc_id"), "text_class", "class_rows", "n_links", "class_id", "kept", "depth")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of `docs`, with their own columns, of which one stays for each class of `near_duplicates`."""
    defaults = {"threshold": THRESHOLD, "recall": RECALL, "trees": TREES, "depth": DEPTH}
    found = _joined(docs, id_col, text_col, **defaults | params)
    keys = {"id": column(docs, id_col), "digest": _digest(column(docs, text_col))}
    return kept_rows(docs, keys, found.select("id", "digest", "kept"))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _joined(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float, trees: int, depth: int) -> DataFrame:
    """What near_duplicates returns, with id and digest of each row."""
    text = column(docs, text_col)
    rows = docs.select(column(docs, id_col).alias("id"), _digest(text).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))
    signed = written(_signed(rows, trees, depth).withColumn("rid", F.monotonically_increasing_id()), "signed")
    classes = signed.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("signature").alias("signature"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    links, ended = _links(rows, classes, threshold, recall, trees, depth)
    last = last_depth(threshold, recall, trees, depth)
    counted = links.groupBy("cid").agg(F.sum("links").alias("links"))
    group = connected_components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    ids = group.join(classes.select(F.col("cid").alias("node"), "id"), "node")
    least = ids.groupBy("component").agg(F.min("id").alias("least"))
    named = group.join(least, "component").select(F.col("node").alias("cid"), "least")
    whole = (
        classes.join(counted, "cid", "left")
        .join(named, "cid", "left")
        .join(ended, "cid", "left")
        .select(
            F.when(F.col("signature").isNotNull(), F.coalesce("depth", F.lit(last))).alias("depth"),
            "digest",
            "cid",
            "copies",
            F.col("signature").isNotNull().alias("worded"),
            F.coalesce("links", F.lit(0)).alias("links"),
            F.when(F.col("signature").isNotNull(), F.coalesce("least", "id")).alias("least"),
        )
    )
    joined = signed.select("rid", "id", "digest").join(written(whole, "whole"), "digest")
    out = joined.select(
        "rid",
        "id",
        "digest",
        F.col("cid").alias("text_class"),
        F.col("copies").alias("class_rows"),
        F.when(F.col("worded"), F.col("links") + F.col("copies") - 1).otherwise(0).alias("n_links"),
        F.when(F.col("worded"), F.col("least")).otherwise(F.col("id")).alias("class_id"),
        "worded",
        "depth",
    )
    out = written(out, "joined")
    # One of the rows that carry the class's smallest id.
    first = (
        out.where("worded and id <=> class_id")
        .groupBy("id", F.when(F.col("id").isNull(), F.col("text_class")).alias("nameless"))
        .agg(F.min("rid").alias("first"))
        .select(F.col("first").alias("rid"), F.lit(True).alias("is_first"))
    )
    kept = ~F.col("worded") | F.coalesce("is_first", F.lit(False))
    return out.join(first, "rid", "left").withColumn("kept", kept)
