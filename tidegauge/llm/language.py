"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams of one to three letters, in order of frequency. A
document's own list is compared with each profile by the out-of-place distance: how far each n-gram's rank is
from its rank in the profile, or the profile's length where the profile lacks it. The nearest profile wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, mapped

#: N-grams of a profile, and of a document, at most.
PROFILE = 400
#: Distinct n-grams that a task gathers before it hands on their counts.
GATHERED = 400_000
UNKNOWN = "und"

_BITS = 18  # letters have code points below 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(1 << _BITS)), bool, 1 << _BITS)


#: Letters whose n-grams are sorted at a time.
CHUNK = 1 << 18


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of several such pairs together, codes ascending."""
    if len(parts) == 1:
        return parts[0]
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of all n-grams of a whole text, in lower case; a blank stands at the ends of each run of letters.

    Some 16 bytes a character are needed at once, and more only for CHUNK letters.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.int32).copy()
    codes[codes >= 1 << _BITS] = 0
    codes[~_letters()[codes]] = 0
    codes = np.concatenate([[0], codes, [0]]).astype(np.int32)
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    if not codes.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = []
    for start in range(0, len(codes) - 1, CHUNK):  # the n-grams that begin in this part
        part = codes[start : start + CHUNK + 2].astype(np.int64)
        one = part[:CHUNK][part[:CHUNK] != 0]
        two = ((part[:-1] << _BITS | part[1:]) + (1 << 60))[:CHUNK]
        inner = part[1:-1] != 0
        three = ((part[:-2] << _BITS | part[1:-1]) << _BITS | part[2:])[inner] + (2 << 60)
        parts.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
    return _merged(parts)


def ranked(text: str, top: int) -> np.ndarray:
    """The text's `top` most frequent n-grams in order; of equally frequent ones the smaller code first."""
    codes, counts = grams(text)
    if len(codes) > top:  # leave out what cannot be among them
        least = np.partition(counts, -top)[-top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")][:top]


@dataclass
class Profiles:
    """Ranks of n-grams: `ranks[i, j]` of n-gram `codes[i]` in language `names[j]`, -1 where it lacks it."""

    names: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    top: int

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]], top: int) -> Profiles:
        names = sorted({r[0] for r in rows})
        codes = np.unique(np.array([r[1] for r in rows], np.int64))
        ranks = np.full((len(codes), len(names)), -1, np.int32)
        for name, code, rank in rows:
            ranks[np.searchsorted(codes, code), names.index(name)] = rank
        return cls(names, codes, ranks, top)

    def nearest(self, text: str | None) -> tuple[str, float]:
        """(language, 1 - distance / largest possible distance); ties go to the first name."""
        mine = ranked(text, self.top) if text else np.zeros(0, np.int64)
        if not len(mine) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == mine)[:, None], self.ranks[at], -1)
        apart = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(mine))[:, None]))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        return self.names[best], 1.0 - int(total[best]) / (self.top * len(mine))


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) summed over as many documents as keep within GATHERED distinct n-grams."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush():
        for lang, parts in held.items():
            codes, counts = _merged(parts)
            yield pa.record_batch([pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])
        held.clear()

    size = 0
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            text, lang = text.as_py(), lang.as_py()
            if text:
                part = grams(text)
                held.setdefault(lang, []).append(part)
                size += len(part[0])
            if size > GATHERED:
                for key in held:
                    held[key] = [_merged(held[key])]
                size = sum(len(p[0][0]) for p in held.values())
                if size > GATHERED // 2:
                    yield from flush()
                    size = 0
    yield from flush()


def learn_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = PROFILE) -> Profiles:
    """Profiles from every whole text of a table with known languages; null texts and languages teach nothing.

    Counts are summed in the tasks first. The driver gets `top` rows for each language.
    """
    rows = labelled.select(column(labelled, text_col).alias("text"), column(labelled, lang_col).alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    counts = mapped(rows, _gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top)
    return Profiles.of([(r.lang, r.gram, r["rank"]) for r in best.collect()], top)


def predict_language(docs: DataFrame, profiles: Profiles, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The columns `keep` (by default all) of each row with lang_pred string and score double.

    Null texts and texts without a letter get `und` and 0; so do all if there are no profiles. Texts are read
    whole whatever their length; equal texts get equal results. Ties between languages go to the first name.
    Columns of the same names as the new ones are to be left out of `keep`. An empty table gives no rows.
    """
    keep = keep or [column(docs, c) for c in docs.columns]
    rows = docs.select(F.struct(*keep).alias("row"), column(docs, text_col).alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.nearest(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return mapped(rows, predict, schema).select("row.*", "lang_pred", "score")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from the learning: crc32 of its id as text leaves 2 by 4. False for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    out = held_out(column(docs, id_col))
    profiles = learn_profiles(docs.where(~out), text_col, lang_col, top)
    return predict_language(docs, profiles, text_col, [column(docs, id_col).alias("doc_id"), out.alias("held_out")])


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.0) -> DataFrame:
    """The rows of `docs`, with their own columns, whose language is found with a score of `least` or more."""
    profiles = learn_profiles(docs.where(~held_out(column(docs, id_col))), text_col, lang_col)
    whole = F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("whole")
    found = predict_language(docs, profiles, text_col, [whole])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("whole.*")
