"""Removal of passages that repeat, by MinHash banding of paragraphs.

Paragraphs are lines of at least `least_words` words. Bands are tuned so that paragraphs at the similarity
threshold collide with the wanted probability. Colliding paragraphs are verified by the exact Jaccard
similarity of their word shingles, and components of verified links are repeats of one passage: all but the first of
them are removed. Equal paragraphs are one class throughout.

Passages that begin or end inside a line, or run over several lines, are found as runs of equal words: windows
start where a text's word shingles have the least hash of their surroundings, so that equal runs are cut alike and each
run of RUN_WORDS holds a window whole. Equal windows are merged along the texts and extended word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidegauge.llm.components import connected_components
from tidegauge.llm.frames import column, forget, fresh, mapped, written
from tidegauge.llm.minhash import (
    BUCKETS,
    SHINGLE,
    THRESHOLD,
    bucket_keys,
    bucket_rows,
    mixed,
    shingles,
    signatures,
    slices_of,
    verified,
)
from tidegauge.llm.units import Unit, collisions

LEAST_WORDS = 25
RECALL = 0.99
#: MinHash values at most.
PERMS = 64
#: Runs of so many words that two texts share are found wherever they begin and end.
RUN_WORDS = 50
#: Words of a window, and successive starts of which the one with the least hash is taken: a run of RUN_WORDS holds a window.
#: Shorter windows are fewer, as more starts are chosen from; what they find is short of RUN_WORDS more often, and dropped.
WINDOW = 15
CHOICES = RUN_WORDS - WINDOW + 1


def tuned_bands(threshold: float = THRESHOLD, recall: float = RECALL, perms: int = PERMS, noise: float = 0.4) -> tuple[int, int]:
    """(bands, values of a band) that meet a pair at the threshold with probability `recall` or more.

    Of those, the tuning with the fewest buckets that meets pairs of similarity `noise` in half the cases at
    most; if there is none, the one that meets such pairs least.
    """
    found = []
    for width in range(1, perms + 1):
        for bands in range(1, perms // width + 1):
            met, stray = (1 - (1 - s**width) ** bands for s in (threshold, noise))
            if met >= recall:
                found.append((max(stray, 0.5), bands, width))
                break
    if not found:
        raise ValueError("no banding reaches that recall")
    return min(found)[1:]


def _lines(texts: pa.Array, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text number, line number in it, first character) of all lines that may have so many words, and the lines."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.split_pattern(texts, "\n")
    lines, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    of = np.repeat(np.arange(len(texts)), np.diff(ends))
    nth = np.arange(len(of)) - ends[:-1][of]
    size = pc.utf8_length(lines).to_numpy()
    place = np.cumsum(size + 1) - (size + 1)
    start = place - place[np.minimum(ends[:-1], max(0, len(place) - 1))][of] if len(of) else place
    long = np.flatnonzero(size >= 2 * least_words - 1)
    return of[long], nth[long], start[long], lines.take(pa.array(long))


def _digests(lines: pa.Array) -> list[bytes]:
    return [hashlib.blake2b(x.strip().lower().encode(), digest_size=16).digest() for x in lines.to_pylist()]


def _paragraphs(rows: DataFrame, least_words: int, bands: int, width: int) -> DataFrame:
    """id, text_key, para, start, length, words, digest and keys (its buckets) of each paragraph of (id, text_key, text)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices_of(batches, "text"):
            of, nth, start, lines = _lines(texts, least_words)
            hashes, offsets = shingles(lines)
            count = np.diff(offsets)
            good = np.flatnonzero(count > max(0, least_words - SHINGLE))
            keys = bucket_keys(signatures(hashes, offsets, bands * width).reshape(-1, bands, width)[good], width)
            lines = lines.take(pa.array(good))
            yield pa.record_batch(
                [
                    part.column(0).take(pa.array(of[good])),
                    part.column(1).take(pa.array(of[good])),
                    pa.array(nth[good], pa.int32()),
                    pa.array(start[good], pa.int64()),
                    pc.utf8_length(lines).cast(pa.int64()),
                    pa.array(count[good] + SHINGLE - 1, pa.int32()),
                    pa.array(_digests(lines), pa.binary()),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                ],
                names=["id", "text_key", "para", "start", "length", "words", "digest", "keys"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(
        rows, gather, f"id {kind}, text_key long, para int, start long, length long, words int, digest binary, keys binary"
    )


def _sets(rows: DataFrame, least_words: int) -> DataFrame:
    """digest and set of shingles of the paragraphs of each (text, wanted), for the digests that are wanted."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices_of(batches, "text"):
            wanted = [set(w) for w in part.column(1).to_pylist()]
            of, _, _, lines = _lines(texts, least_words)
            digests = _digests(lines)
            hit = [i for i, (t, d) in enumerate(zip(of.tolist(), digests, strict=True)) if d in wanted[t]]
            hashes, offsets = shingles(lines.take(pa.array(hit, pa.int64())))
            data = [np.unique(hashes[a:b]).tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.record_batch([pa.array([digests[i] for i in hit], pa.binary()), pa.array(data, pa.binary())], names=["digest", "shingles"])

    return mapped(rows.select("text", "wanted"), gather, "digest binary, shingles binary")


def _buckets(classes: DataFrame) -> DataFrame:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield bucket_rows(batch.column(0).to_numpy(), np.stack([np.frombuffer(k, np.int64) for k in batch.column(1).to_pylist()]))

    return mapped(classes.select("cid", "keys"), spread, BUCKETS)


def _keys_of(unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    keys = np.stack([np.frombuffer(k, np.int64) for k in unit["keys"]])
    return keys, keys[:, :0]


def _cuts(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the windows of texts with these shingles: text number, first word, hash, first word of the text's next window (-1 if
    there is none) and a hash of all words up to there (0 without)."""
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.zeros(0, np.int64)
    if len(hashes) >= CHOICES:
        least = np.lib.stride_tricks.sliding_window_view(hashes, CHOICES).argmin(axis=1) + np.arange(len(hashes) - CHOICES + 1)
        at = np.unique(least[of[: len(least)] == of[CHOICES - 1 :]])
    at = at[at + WINDOW - SHINGLE < offsets[1:][of[at]]]
    last = np.concatenate([of[at][1:] != of[at][:-1], [True]])[: len(at)]
    until = np.where(last, at, np.concatenate([at[1:], [0]])[: len(at)])
    name, way = np.zeros(len(at), np.uint64), (until - at).astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in [*range(0, WINDOW - SHINGLE, SHINGLE), WINDOW - SHINGLE]:  # together all words of the window
            name = mixed(name * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k])
        for k in range(0, CHOICES + SHINGLE, SHINGLE):
            way = mixed(way * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[np.minimum(at + k, until)])
    base = offsets[of[at]]
    return of[at], at - base, name.view(np.int64), np.where(last, -1, until - base), np.where(last, 0, way.view(np.int64))


def _windows(rows: DataFrame) -> DataFrame:
    """id, text_key, at (first word), hash, the text's next window, the hash of the way there, prior (first word of the last equal
    window before it in the text, or null) and alike (whether the way from there is the same) of each window of (id, text_key, text)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices_of(batches, "text"):
            found = _cuts(*shingles(texts))
            order = np.lexsort((found[1], found[2], found[0]))
            of, at, name, after, way = (x[order] for x in found)
            again = np.concatenate([[False], (of[1:] == of[:-1]) & (name[1:] == name[:-1])])[: len(of)]
            alike = (after >= 0) & (way == np.roll(way, 1))
            of, prior = pa.array(of), pa.array(np.roll(at, 1), pa.int32(), mask=~again)
            places = [pa.array(at, pa.int32()), pa.array(name), pa.array(after, pa.int32()), pa.array(way), prior, pa.array(alike)]
            names = ["id", "text_key", "at", "name", "after", "way", "prior", "alike"]
            yield pa.record_batch([part.column(0).take(of), part.column(1).take(of), *places], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, gather, f"id {kind}, text_key long, at int, name long, after int, way long, prior int, alike boolean")


@lru_cache(maxsize=1)
def _blanks() -> np.ndarray:
    """Which code points part words, as in shingles(); none of 0x3001 or above does."""
    return np.append(pc.utf8_is_space(pa.array([chr(i) for i in range(0x3001)])).to_numpy(zero_copy_only=False), False)


def _word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(first character, character after the last) of each word of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.concatenate([[True], _blanks()[np.minimum(codes, 0x3001)], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


def _names(words: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in words]


def _surroundings(rows: DataFrame) -> DataFrame:
    """For each of the `wanted` spans (first word, word after the last) of (id, text_key, text, wanted): a digest of its words, the
    hashes of the words before and after it, nearest first, all in lower case; and the places in characters where it starts, or would with more of them, and ends."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices_of(batches, "text"):
            found = []
            for i, (text, wanted) in enumerate(zip(texts.to_pylist(), part.column(3).to_pylist(), strict=True)):
                first, last = _word_places(text)
                for span in wanted:
                    s, e = span["s"], span["e"]
                    low, high = max(0, s - CHOICES), min(len(first), e + CHOICES)
                    words = [text[x:y].lower() for x, y in zip(first[low:high].tolist(), last[low:high].tolist(), strict=True)]
                    core = hashlib.blake2b(" ".join(words[s - low : e - low]).encode(), digest_size=16).digest()
                    beside = _names(words[: s - low][::-1]), _names(words[e - low :])
                    found.append((i, s, e, core, *beside, first[low : s + 1][::-1], last[e - 1 : high]))
            of, s, e, core, before, after, starts, ends = zip(*found, strict=True) if found else [()] * 8
            of = pa.array(of, pa.int64())
            columns = [part.column(0).take(of), part.column(1).take(of), pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(core, pa.binary())]
            columns += [pa.array(x, pa.list_(pa.int64())) for x in (before, after)]
            columns += [pa.array(x, pa.list_(pa.int32())) for x in (starts, ends)]
            yield pa.record_batch(columns, names=["id", "text_key", "s", "e", "core", "before", "after", "starts", "ends"])

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(
        rows.select("id", "text_key", "text", "wanted"), gather, f"id {kind}, text_key long, s long, e long, core binary, before array<long>, after array<long>, starts array<int>, ends array<int>"
    )


def _alike(a: Column, b: Column) -> Column:
    """With how many equal elements two arrays begin."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("long")


def _runs(rows: DataFrame) -> DataFrame:
    """Runs of words of (id, text_key, text) that an earlier place has too: id, text_key, start, length, words, copies (rows of
    that id and text) and the same of the earlier place, keep_*.

    The earlier place is, for the windows of the run, the last one before in the same text or else the first of all (smallest
    id, then text_key, then word). Where runs
    with different earlier places overlap, they count together for RUN_WORDS.
    """
    windows = written(_windows(rows), "windows")
    once = windows.where("prior is null").drop("prior", "alike")
    # First which windows repeat at all, by their names alone: most do not, and go no further.
    repeated = once.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    again = written(once.join(repeated, "name"), "again")
    first = F.min(F.struct("id", "text_key", "at", "way")).alias("first")
    spot = ["id", "text_key", "at"]
    same_place = F.struct(*spot).eqNullSafe(F.struct(*[F.col(f"first.{c}").alias(c) for c in spot]))
    hits = again.join(again.groupBy("name").agg(first), "name").where(~same_place)
    where = ["id", "text_key", "keep_id", "keep_key", "shift"]
    hits = hits.select("id", "text_key", F.col("first.id").alias("keep_id"), F.col("first.text_key").alias("keep_key"), (F.col("at") - F.col("first.at")).alias("shift"), "at", "after", ((F.col("after") >= 0) & (F.col("way") == F.col("first.way"))).alias("alike"))
    inside = windows.where("prior is not null")
    inside = inside.select("id", "text_key", F.col("id").alias("keep_id"), F.col("text_key").alias("keep_key"), (F.col("at") - F.col("prior")).alias("shift"), "at", "after", "alike")
    hits = hits.union(inside)
    along = Window.partitionBy(*where).orderBy("at")
    # A window goes on with the one before if it begins in it, or if all words from there to here are the same.
    joined = F.lag(F.when(F.col("alike"), F.col("after"))).over(along).eqNullSafe(F.col("at"))
    parted = (F.coalesce(F.col("at") > F.lag("at").over(along) + WINDOW, F.lit(True)) & ~joined).cast("int")
    spans = hits.withColumn("parted", parted).withColumn("part", F.sum("parted").over(along)).groupBy(*where, "part")
    spans = spans.agg(F.min("at").cast("long").alias("s"), (F.max("at") + WINDOW).cast("long").alias("e")).drop("part")
    spans = written(spans.withColumn("shift", F.col("shift").cast("long")), "spans")
    forget(windows, again)
    theirs = spans.select(F.col("keep_id").alias("id"), F.col("keep_key").alias("text_key"), (F.col("s") - F.col("shift")).alias("s"), (F.col("e") - F.col("shift")).alias("e"))
    wanted = spans.select("id", "text_key", "s", "e").union(theirs).groupBy("id", "text_key").agg(F.collect_set(F.struct("s", "e")).alias("wanted"))
    wanted = wanted.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "wanted")
    around = _surroundings(rows.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))))
    names = ("core", "before", "after", "starts", "ends")
    around = around.groupBy("id", "text_key", "s", "e").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in names])
    around = written(around, "surroundings")
    mine, other = (around.select(*[F.col(c).alias(f"{side}_{c}") for c in around.columns]) for side in ("m", "k"))
    at_mine = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_text_key")) & (F.col("s") == F.col("m_s")) & (F.col("e") == F.col("m_e"))
    at_kept = F.col("keep_id").eqNullSafe(F.col("k_id")) & (F.col("keep_key") == F.col("k_text_key"))
    at_kept = at_kept & (F.col("s") - F.col("shift") == F.col("k_s")) & (F.col("e") - F.col("shift") == F.col("k_e"))
    both = spans.join(mine, at_mine).join(other, at_kept).where("m_core = k_core")
    both = both.withColumn("left", _alike(F.col("m_before"), F.col("k_before"))).withColumn("right", _alike(F.col("m_after"), F.col("k_after")))

    def place(side: str) -> list[Column]:
        start = F.get(f"{side}_starts", F.col("left").cast("int"))
        return [start.cast("long"), (F.get(f"{side}_ends", F.col("right").cast("int")) - start).cast("long")]

    parts = both.select(
        *where,
        *[x.alias(n) for x, n in zip(place("m"), ("start", "length"), strict=True)],
        (F.col("s") - F.col("left")).alias("s"),
        (F.col("e") + F.col("right")).alias("e"),
        F.col("m_copies").alias("copies"),
        *[x.alias(n) for x, n in zip(place("k"), ("keep_start", "keep_length"), strict=True)],
        F.col("k_copies").alias("keep_copies"),
    )
    # Windows of one run may lie apart; extended, they meet.
    run = Window.partitionBy(*where).orderBy("s", "e")
    till = F.max("e").over(run.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("apart", F.coalesce(F.col("s") > till, F.lit(True)).cast("int"))
    parts = parts.withColumn("part", F.sum("apart").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    ends = [(F.max(F.col(f"{k}start") + F.col(f"{k}length")) - F.min(f"{k}start")).alias(f"{k}length") for k in ("", "keep_")]
    grown = parts.groupBy(*where, "part").agg(
        F.min("start").alias("start"), ends[0], F.min("s").alias("s"), F.max("e").alias("e"), F.max("copies").alias("copies"),
        F.min("keep_start").alias("keep_start"), ends[1], F.max("keep_copies").alias("keep_copies"),
    ).drop("part", "shift")
    text = Window.partitionBy("id", "text_key").orderBy("s", "e")
    till = F.max("e").over(text.rowsBetween(Window.unboundedPreceding, -1))
    grown = grown.withColumn("parted", F.coalesce(F.col("s") > till - SHINGLE, F.lit(True)).cast("int"))
    grown = grown.withColumn("part", F.sum("parted").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("id", "text_key", "part")
    long = grown.withColumn("all", F.max("e").over(whole) - F.min("s").over(whole)).where(F.col("all") >= RUN_WORDS)
    return long.withColumn("words", (F.col("e") - F.col("s")).cast("int")).drop("s", "e", "parted", "part", "all")


def _run_rows(rows: DataFrame, lines: DataFrame, least_words: int) -> DataFrame:
    """The rows that repeated_passages returns for runs; `lines` are those it returns for lines.

    A run gives no row if what the removed lines leave of it is too short for `least_words`.
    """
    runs = written(_runs(rows), "runs")
    gone = lines.where("not kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    gone = gone.agg(F.collect_set(F.struct("start", "length")).alias("gone"))
    joined = runs.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    end = F.col("start") + F.col("length")
    covered = F.aggregate(
        F.coalesce("gone", F.array().cast("array<struct<start:bigint,length:bigint>>")),
        F.lit(0).cast("long"),
        lambda sum, x: sum + F.greatest(F.lit(0).cast("long"), F.least(end, x["start"] + x["length"]) - F.greatest(F.col("start"), x["start"])),
    )
    left = joined.where(F.col("length") - covered >= 2 * least_words - 1)
    passage = -1 - F.shiftrightunsigned(F.xxhash64("keep_id", "keep_key", "keep_start", "keep_length"), 1)
    left = left.withColumn("passage_id", passage).select("passage_id", *runs.columns)
    left = written(left, "run_rows")
    theirs = ["keep_id", "keep_key", "keep_start", "keep_length", "words", "keep_copies"]
    sizes = left.groupBy("passage_id").agg((F.sum("copies") + F.first("keep_copies")).alias("passage_rows"), *[F.first(c).alias(c) for c in theirs])

    def shaped(df: DataFrame, place: list[str], kept: bool) -> DataFrame:
        doc, key, start, length, copies = place
        return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(
            F.col(doc).alias("doc_id"),
            F.col(key).alias("text_key"),
            F.lit(None).cast("int").alias("para"),
            F.col(start).alias("start"),
            F.col(length).alias("length"),
            "words",
            "passage_id",
            "passage_rows",
            F.col("keep_id").alias("keep_doc_id"),
            F.lit(None).cast("int").alias("keep_para"),
            F.lit(kept).alias("kept"),
        )

    removed = left.join(sizes.select("passage_id", "passage_rows"), "passage_id")
    first = shaped(sizes, ["keep_id", "keep_key", "keep_start", "keep_length", "keep_copies"], True)
    return shaped(removed, ["id", "text_key", "start", "length", "copies"], False).unionByName(first)


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
    runs: bool = False,
) -> DataFrame:
    """One row per paragraph or run of words that repeats: doc_id, text_key, para, start, length, words, passage_id, passage_rows,
    keep_doc_id, keep_para, kept.

    `para` counts the lines of a text from 0, `start` and `length` are its place in characters; `passage_id` names
    the component, which has `passage_rows` paragraphs, and the first of them (smallest doc_id, then
    text_key, then para) is kept. `text_key` is a hash of the whole text, which tells apart rows of one id; of rows
    equal in id and text each has its own rows here, all kept or none. Paragraphs that occur once give no rows, nor do null and empty texts and
    short lines. Null ids come first. Texts and lines are read whole. Further columns are ignored.

    With `runs`, runs of RUN_WORDS words or more that an earlier place has too, wherever they begin and end, have rows too,
    with null `para` and `keep_para`; their passages are the places kept, with a row for each, and have negative ids. A place that one
    passage keeps may be removed for a still earlier one.
    """
    bands, width = tuned_bands(threshold, recall)
    text = column(docs, text_col)
    rows = docs.select(column(docs, id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    paragraphs = written(_paragraphs(rows.where("text is not null"), least_words, bands, width), "paragraphs")
    classes = paragraphs.groupBy("digest").agg(
        F.count("*").alias("copies"), F.first("keys").alias("keys"), F.first(F.struct("id", "text_key")).alias("at")
    )
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    units = written(collisions(_buckets(classes)), "units")
    needed = units.select("cid").distinct().join(classes.select("cid", "digest", "copies", "keys", "at"), "cid")
    wanted = needed.groupBy("at.id", "at.text_key").agg(F.collect_set("digest").alias("wanted"))
    texts = rows.join(
        wanted.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "wanted"),
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")),
    )
    sets = _sets(texts, least_words).dropDuplicates(["digest"])
    payload = needed.join(sets, "digest").select("cid", "copies", "keys", "shingles")
    links = written(verified(units, payload, threshold, _keys_of), "links")
    group = connected_components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(group.select(F.col("node").alias("cid"), "component"), "cid", "left")
        .where("copies > 1 or component is not null")
        .select("digest", F.coalesce("component", "cid").alias("passage_id"))
    )
    found = written(paragraphs.drop("keys").join(named, "digest").drop("digest"), "repeats")
    forget(paragraphs, classes, units, links)
    first = F.min(F.struct("id", "text_key", "para"))
    best = found.groupBy("passage_id").agg(F.count("*").alias("passage_rows"), first.alias("first"))
    mine = F.struct("id", "text_key", "para")
    lines = found.join(best, "passage_id").select(
        F.col("id").alias("doc_id"),
        "text_key",
        "para",
        "start",
        "length",
        "words",
        "passage_id",
        "passage_rows",
        F.col("first.id").alias("keep_doc_id"),
        F.col("first.para").alias("keep_para"),
        mine.eqNullSafe(F.col("first")).alias("kept"),
    )
    if not runs:
        return lines
    lines = written(lines, "lines")
    return lines.unionByName(_run_rows(rows.where("text is not null"), lines, least_words))


@F.udf(StringType(), useArrow=True)
def _cut(text, gone):
    """`text` without the lines and runs (para, start, length) that are gone, and without lines of which they leave only white space."""
    if gone is None:
        return None
    lines = {x["para"] for x in gone if x["para"] is not None}
    runs = sorted((x["start"], x["start"] + x["length"]) for x in gone if x["para"] is None)
    left, place = [], 0
    for i, line in enumerate(text.split("\n")):
        if i not in lines:
            kept, at = [], place
            for a, b in runs:
                if a < place + len(line) and b > at:
                    kept.append(text[at : max(a, at)])
                    at = min(b, place + len(line))
            kept = "".join([*kept, text[at : place + len(line)]])
            if kept == line or kept.strip():
                left.append(kept)
        place += len(line) + 1
    return "\n".join(left)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """`docs` with the paragraphs (and runs, if asked for) taken out of their texts that repeat an earlier one; same columns and rows."""
    text = column(docs, text_col)
    gone = repeated_passages(docs, id_col, text_col, **params).where("not kept")
    gone = gone.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("para", "start", "length")).alias("gone"))
    row, gone_ = fresh("row", docs.columns), fresh("gone", docs.columns)
    rows = docs.select(
        F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias(row), column(docs, id_col).alias("_id"), F.xxhash64(text).alias("_key")
    )
    marked = rows.join(
        gone.withColumnRenamed("gone", gone_), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")), "left"
    )
    whole = F.col(row).getField(text_col)
    left = _cut(F.when(F.col(gone_).isNotNull(), whole), F.col(gone_))
    new = F.when(F.col(gone_).isNull(), whole).otherwise(left)
    return marked.select(*[new.alias(c) if c == text_col else F.col(row).getField(c).alias(c) for c in docs.columns])
