"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed where the text is read. How many distinct documents of a host hold a line is
counted over all of them; lines above the host's limit are removed (menus, notices, footers), and documents that
lose too much by that are rejected. Word and line rules within a document come first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, written

#: A line is removed if more than this share of the host's distinct documents hold it, and more than LEAST of them.
SHARE = 0.05
LEAST = 20
#: A document is depleted if fewer words are left, or less than this share of them.
WORDS_LEFT = 50
SHARE_LEFT = 0.5
#: Removed lines up to so many are broadcast (16 bytes and the host's name each); more are joined by shuffle.
BROADCAST_LINES = 200_000
#: Parts in which the rows of one line are dealt where they are shuffled.
SALTS = 16

#: White space between words, and the characters counted as symbols.
_SPACE = r"[\x20\x09-\x0D]+"
_BLANK_IN_LINE = r"[\x20\x09\x0B-\x0D]+"
_WORD_CHAR = r"[^\x20\x09-\x0D]"
_SYMBOLS = r"[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, in order: maximal runs of characters other than blank and U+0009 to U+000D."""
    flat = F.trim(F.regexp_replace(text, _SPACE, " "))
    return let(flat, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ")))


def repeated_words(words: Column, window: int = 3) -> Column:
    """How many words stand in windows of `window` words that occur at least twice in the array."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - window, F.lit(0)))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))

    def covered(found: Column) -> Column:
        at = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            return F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))

        starts = F.sort_array(F.transform(let(at, twice), lambda x: x["i"]))
        none = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"))
        return F.aggregate(starts, none, step, lambda a: a["n"])

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(words) > window, some).otherwise(0).cast("long")


def repeated_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line of the same text."""
    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD_CHAR))
    return let(worded, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def normalised(text: Column) -> Column:
    """The text in lower case, its numbers as 0, with single blanks and none at the ends of lines."""
    plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, _BLANK_IN_LINE, " "), " ?\n ?", "\n"))


def line_hashes(text: Column) -> Column:
    """(h, n) of each line in order: a hash of the normalised line and its number of words; 0 words for a blank one."""

    def of(line: Column) -> Column:
        blanks = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
        return F.struct(F.xxhash64(line).alias("h"), F.when(line == "", 0).otherwise(blanks + 1).alias("n"))

    return F.transform(F.split(normalised(text), "\n"), of)


def document_measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """rid, doc_id, host, text_hash, the measures of each whole text, and its lines' hashes, in one pass over the texts."""
    text = F.coalesce(column(docs, text_col), F.lit(""))
    whole = docs.select(
        column(docs, id_col).alias("doc_id"),
        F.coalesce(column(docs, host_col).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_hash"),
        let(words_of(text), _word_measures).alias("m"),
        F.regexp_count(text, F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        line_hashes(text).alias("lines"),
    )
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    flat = whole.select("doc_id", "host", "text_hash", "m.*", "n_symbols", "n_dup_lines", "lines")
    return flat.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "host", "text_hash", *measures, "lines")


def _word_measures(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        repeated_words(words).alias("n_repeat_words"),
    )


def frequent_lines(measured: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(host, h, n_documents): lines above their host's limit. Equal texts of a host are one document.

    Counts are summed in the tasks that read the lines first, so a line of every document shuffles few rows.
    """
    texts = measured.select("host", "text_hash", "lines").dropDuplicates(["host", "text_hash"])
    texts = written(texts, "texts")
    hosts = texts.groupBy("host").agg(F.count("*").alias("documents"))
    worded = F.filter("lines", lambda x: x["n"] > 0)
    held = texts.select("host", F.explode(F.array_distinct(F.transform(worded, lambda x: x["h"]))).alias("h"))
    counts = held.groupBy("host", "h").agg(F.count("*").alias("n_documents")).where(F.col("n_documents") > least)
    return counts.join(hosts, "host").where(F.col("n_documents") > share * F.col("documents")).select("host", "h", "n_documents")


def removed_words(measured: DataFrame, frequent: DataFrame, bound: int = BROADCAST_LINES) -> DataFrame:
    """(rid, removed): the words on frequent lines of each row that has some."""
    lines = measured.select("rid", "host", F.explode("lines").alias("x")).select("rid", "host", "x.h", "x.n").where("n > 0")
    if frequent.limit(bound + 1).count() <= bound:
        hits = lines.join(F.broadcast(frequent.select("host", "h")), ["host", "h"])
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        dealt = lines.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
        hits = dealt.join(frequent.select("host", "h", salts), ["host", "h", "salt"])
    return hits.groupBy("rid").agg(F.sum("n").cast("long").alias("removed"))


def judge_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    share: float = SHARE,
    least: int = LEAST,
    words_left: int = WORDS_LEFT,
    share_left: float = SHARE_LEFT,
) -> DataFrame:
    """One row per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, kept.

    `base_failed`: under 50 words, or over half of the words in repeated windows of three. `kept` is false for those, and
    for documents of which fewer than `words_left` words or less than `share_left` of them are left without the frequent
    lines of their host. A null or empty text has no words and fails. Rows without a host form one host. Copies
    count as one document of their host and are judged alike, as are repeated rows and null ids. Texts are read whole
    whatever their length. Further columns are ignored. An empty table gives no rows.
    """
    return _judged(docs, id_col, text_col, host_col, share, least, words_left, share_left)[0]


def _judged(docs, id_col, text_col, host_col, share, least, words_left, share_left) -> tuple[DataFrame, DataFrame]:
    measured = written(document_measures(docs, id_col, text_col, host_col), "measures")
    frequent = written(frequent_lines(measured, share, least), "frequent")
    lost = removed_words(measured, frequent)
    removed = F.coalesce("removed", F.lit(0).cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - removed
    depleted = (left < words_left) | (left < share_left * F.col("n_words"))
    out = measured.drop("lines").join(lost, "rid", "left")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = out.select("doc_id", *names, failed.alias("base_failed"), removed.alias("n_removed_words"), (~failed & ~depleted).alias("kept"))
    return out, frequent


def cleaned_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    share: float = SHARE,
    least: int = LEAST,
    words_left: int = WORDS_LEFT,
    share_left: float = SHARE_LEFT,
) -> DataFrame:
    """The rows of `docs` that `judge_lines` keeps, with their own columns, their texts without the frequent lines.

    What becomes of a row depends on its host and text alone; only texts that lose lines or are rejected are joined.
    """
    measured = written(document_measures(docs, id_col, text_col, host_col), "measures")
    frequent = written(frequent_lines(measured, share, least), "frequent")
    texts = measured.dropDuplicates(["host", "text_hash"])
    lost = removed_words(texts, frequent)
    held = texts.select("host", "text_hash", F.explode("lines").alias("x")).where("x.n > 0").select("host", "text_hash", F.col("x.h").alias("h"))
    gone = held.join(frequent, ["host", "h"]).groupBy("host", "text_hash").agg(F.collect_set("h").alias("gone"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    bad = failed | (left < words_left) | (left < share_left * F.col("n_words"))
    marks = texts.join(lost, "rid", "left").select("host", "text_hash", bad.alias("bad")).join(gone, ["host", "text_hash"], "left")
    marks = marks.where("bad or gone is not null").select(F.col("host").alias("_host"), F.col("text_hash").alias("_hash"), "bad", "gone")
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(
        F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("row"),
        F.coalesce(column(docs, host_col).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_hash"),
    )
    joined = rows.join(marks, (F.col("host") == F.col("_host")) & (F.col("text_hash") == F.col("_hash")), "left").where("bad is null or not bad")
    own = F.col("row")[text_col]
    stays = F.filter(
        F.arrays_zip(F.split(own, "\n").alias("line"), line_hashes(own).alias("x")),
        lambda z: (z["x"]["n"] == 0) | ~F.array_contains(F.col("gone"), z["x"]["h"]),
    )
    clean = F.when(F.col("gone").isNull(), own).otherwise(F.array_join(F.transform(stays, lambda z: z["line"]), "\n"))
    return joined.select(*[clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
