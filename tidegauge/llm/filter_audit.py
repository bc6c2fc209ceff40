"""How filters interact: what each removes in every order in which they can be applied.

Each document is reduced to a mask, one bit for each filter that it fails, and the documents to cells of equal part and
mask. A recursive query extends prefixes of orders by letters not yet used, takes the mask cells along with the bits
applied so far, and each level of the recursion emits what its step does with each cell.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, written

#: Filters at most: all orders of them are listed, and six have 1,957 prefixes and 64 masks.
MOST_FILTERS = 6

_WORDS = r"[^\x20\x09-\x0D]+"


def text_mask(text: Column) -> Column:
    """The filters A to D that a text (not null) fails, as bits 0 to 3."""
    words = F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))

    def bit(failed: Column, place: int) -> Column:
        return failed.cast("int") * (1 << place)

    def of_words(w: Column) -> Column:
        return bit(F.size(w) < 200, 0) + bit(100 * F.size(F.array_distinct(w)) < 50 * F.size(w), 1)

    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    shouted = bit(100 * capitals > 3 * F.length(text), 2)
    return F.transform(F.array(words), of_words)[0] + shouted + bit(text.rlike(r"[#$%&*|]"), 3)


#: Bit of filter E, which a document fails whose text a smaller id has.
_REPEAT = 1 << 4


def document_cells(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    label_id: str = "doc_id",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents that fail the same filters A to E, bit 0 for A.

    E fails a document whose text a smaller id has. Rows are counted by text, part and id first, so that copies
    are few rows before any of them meet. Null ids are neither smaller nor larger than others and have no label; a null
    part is the empty one. Labels that name an id more than once mark it if one of them does.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    slim = docs.select(
        column(docs, id_col).cast("long").alias("id"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        F.coalesce(column(docs, part_col).cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"),
    )
    rows = written(slim.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n")), "rows")
    marks = labels.select(column(labels, label_id).cast("long").alias("id"), column(labels, "quality").alias("q"), column(labels, "toxic").alias("t"))
    marks = marks.groupBy("id").agg(F.max(F.when(F.col("q") == 1, 1)).alias("good"), F.max(F.when(F.col("t") == 1, 1)).alias("toxic"))
    marked = rows.join(marks, "id", "left").select("id", "digest", "part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # Of each text: its rows by part and labels, with the smallest id among them and the rows that have it.
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    nameless = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0))
    once = marked.groupBy("id", "digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    kinds = once.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), first.alias("first"), nameless.alias("nameless"))
    kinds = written(kinds, "kinds")
    least = kinds.groupBy("digest").agg(F.min("first.id").alias("least"))
    found = kinds.join(least, "digest")
    original = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), original.alias("n")),
            F.struct((F.col("mask") + F.lit(_REPEAT)).alias("mask"), (F.col("n") - original).alias("n")),
        )
    )
    cells = found.select("part", "good", "toxic", split.alias("c"))
    total = F.sum("c.n").cast("long")
    cells = cells.groupBy("part", F.col("c.mask").alias("mask")).agg(
        total.alias("n"), F.sum(F.col("c.n") * F.col("good")).cast("long").alias("good"), F.sum(F.col("c.n") * F.col("toxic")).cast("long").alias("toxic")
    )
    return cells


_WALK = """
WITH RECURSIVE walk (prefix, letter, bit, applied, step, mask) AS (
  SELECT CAST('' AS STRING), CAST('' AS STRING), 0, 0, 0, mask FROM {masks}
  UNION ALL
  SELECT concat(w.prefix, f.letter), f.letter, f.bit, w.applied | w.bit, w.step + 1, w.mask
  FROM walk w JOIN (SELECT * FROM VALUES %s AS f(letter, bit)) f ON ((w.applied | w.bit) & f.bit) = 0
)
SELECT prefix, letter, step, mask,
       (mask & (applied | bit)) = 0 AS kept,
       (mask & bit) != 0 AND (mask & applied) = 0 AS removed,
       (mask & bit) != 0 AND (mask & applied) != 0 AS redundant,
       mask = bit AS only_this
FROM walk WHERE step > 0
"""


def audit_orders(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of all `letters` and step: what the step's filter does after those before it.

    `cells` as from document_cells, a letter's bit being its place in `letters`. Columns: part, filter_order, step, kept
    (after this step), removed (here), redundant (failing, but removed before), unique_fails (failing this filter only),
    good_lost, toxic_lost (removed here) and shapley, the filter's removals summed over all orders. The recursion sees
    each mask once, whatever the number of parts or documents. Parts without failures have their rows too; no cells give no
    rows. At most MOST_FILTERS letters.
    """
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters, all orders of which are listed")
    spark = cells.sparkSession
    cells = written(cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]), "cells")
    bits = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(letters))
    walk = spark.sql(_WALK % bits, masks=cells.select(F.col("mask").cast("int").alias("mask")).distinct())

    def over(value: str, mark: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(mark), F.col(value))), F.lit(0)).cast("long")

    steps = cells.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "letter", "step")
    sums = steps.agg(
        over("n", "kept").alias("kept"),
        over("n", "removed").alias("removed"),
        over("n", "redundant").alias("redundant"),
        over("n", "only_this").alias("unique_fails"),
        over("good", "removed").alias("good_lost"),
        over("toxic", "removed").alias("toxic_lost"),
    )
    sums = written(sums, "steps")
    orders = spark.createDataFrame([("".join(p),) for p in permutations(letters)], "filter_order string")
    grown = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    grown = grown.select("filter_order", F.expr("substring(filter_order, 1, step)").alias("prefix"))
    listed = sums.join(F.broadcast(grown), "prefix")
    shapley = listed.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return listed.join(shapley, ["part", "letter"]).select("part", "filter_order", F.col("step").cast("int").alias("step"), *names)


def audit_filters(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """audit_orders of the five filters on whole texts, by language.

    A: under 200 words; B: under half of the words distinct; C: over 3 of 100 characters are A-Z; D: holds one of
    `#$%&*|`; E: a smaller id has the same text. Null texts are empty ones, equal to each other: they fail A, and E
    but for the first. Repeated rows all count; rows equal in id and text pass or fail E together. Very long texts
    are read whole. Further columns are ignored. An empty table gives no rows.
    """
    return audit_orders(document_cells(docs, labels, **columns))
