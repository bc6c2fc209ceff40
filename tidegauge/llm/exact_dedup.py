"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

Misra-Gries counters find digests that may be frequent. Their exact counts and winners are then
computed (partial sums on the map side) and broadcast, so that rows of frequent digests are decided
where they are read. All other digests go through one ordinary shuffle, in which no key is frequent.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, kept_rows, written

#: Counters of the Misra-Gries summary, and the digests that it may report: the bound of the broadcast.
COUNTERS = 8192
HEAVY = 1024
#: A reported digest is decided by broadcast if it has so many rows. Results do not depend on it.
HEAVY_ROWS = 64


def fold_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _heavy(slim: DataFrame, counters: int, heavy: int, rows: int) -> DataFrame:
    """Verified frequent digests with their size and winner; at most `heavy` rows."""
    top = slim.agg(F.expr(f"approx_top_k(digest, {heavy}, {counters})").alias("top"))
    found = top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest"))
    best = F.max(F.struct(F.col("id").isNotNull().alias("some"), F.col("id"), (-F.col("seq")).alias("seq")))
    return (
        slim.join(F.broadcast(found), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), best.alias("w"))
        .where(F.col("n") >= rows)
        .select("digest", "n", F.col("w.id").alias("winner"), (-F.col("w.seq")).alias("first"))
    )


def _decided(
    docs: DataFrame, id_col: str, text_col: str, counters: int, heavy: int, heavy_rows: int
) -> DataFrame:
    slim = written(
        docs.select(
            column(docs, id_col).alias("id"),
            F.sha2(fold_ascii(column(docs, text_col)), 256).alias("digest"),
            F.monotonically_increasing_id().alias("seq"),
        ),
        "digests",
    )
    winners = written(_heavy(slim, counters, heavy, heavy_rows), "heavy")
    marked = slim.join(F.broadcast(winners), "digest", "left")
    by_hit = marked.where("n is not null").select(
        "id", "digest", F.col("winner").alias("keep_id"), F.col("n").alias("group_size"), (F.col("seq") == F.col("first")).alias("kept")
    )
    order = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last(), "seq")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_shuffle = marked.where("n is null").select(
        "id",
        "digest",
        F.first("id").over(whole).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
    )
    return by_hit.union(by_shuffle)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    counters: int = COUNTERS,
    heavy: int = HEAVY,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null is the empty text, so nulls and empty
    texts form one group. The row with the largest id stays; a null id stays only if the group has no
    other. Of rows with the same id and text one stays. Very long texts are hashed whole. Further
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    found = _decided(docs, id_col, text_col, counters, heavy, heavy_rows)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of `docs` that stay, with their own columns in their own order.

    Same rules as `exact_groups`. Rows that agree in id and text but differ elsewhere: the one whose
    columns, as JSON text, come first stays.
    """
    found = exact_groups(docs, id_col, text_col, **params).select("doc_id", "text_sha256", "kept")
    keys = {"doc_id": column(docs, id_col), "text_sha256": F.sha2(fold_ascii(column(docs, text_col)), 256)}
    return kept_rows(docs, keys, found)
