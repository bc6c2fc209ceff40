"""Quality scores by co-training of a text view and a page-metadata view.

One logistic regression sees the words of a document, the other its metadata: source, language, length and
layout. Each is fitted on all labelled documents but those kept apart; over some rounds each scores all documents that have no
label, and all of which it is confident teach the other. In the end both are calibrated on all labelled documents kept
apart, and their evidence is added up. Nothing is sampled: features are written once, labels are a column beside them.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.quantiles import exact_quantiles
from tidegauge.llm.frames import column, forget, written
from tidegauge.llm.mixing import document_features

ROUNDS = 2
#: A view is confident where its probability is this far from 0 or 1 at most.
CONFIDENT = 0.05
META_BUCKETS = 1 << 10
#: The text view keeps so many words, those that tell the classes apart best (chi-square), each in some documents at least.
TELLING, LEAST_DOCS = 1024, 8
#: Share of the good documents kept apart that are to be kept, and the least score to keep where there are none.
GOOD_SHARE, KEEP = 0.97, 0.3

_SIGNS = {"bang": "!", "bar": "|", "amp": "&", "percent": "%", "hash": "#", "star": "*", "dollar": "$"}
_SHAPE = ("log_chars", "log_words", "log_lines", "word_length", "line_words", "distinct", "wide", *_SIGNS)


def _metadata(docs: DataFrame, text: Column, category_cols: tuple[str, ...]) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    size = F.length(text)
    more = {"chars": size, "lines": size - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, "wide": (F.octet_length(text) - size) / (size + 1)}
    more |= {name: (size - F.length(F.replace(text, F.lit(sign), F.lit("")))) / (size + 1) for name, sign in _SIGNS.items()}
    have = {c.lower() for c in docs.columns}
    return more | {f"cat{i}": column(docs, c).cast("string") for i, c in enumerate(category_cols) if c.lower() in have}


def view_features(docs: DataFrame, id_col: str, text_col: str, category_cols: tuple[str, ...]) -> DataFrame:
    """id, text_key, features (of the text view) and the columns of the metadata view, from whole texts."""
    more = _metadata(docs, column(docs, text_col), category_cols)
    raw = document_features(docs, id_col, text_col, more)
    words, lines = F.col("tokens"), F.col("lines")
    shape = {
        "log_chars": F.log1p("chars"),
        "log_words": F.log1p(words.cast("double")),
        "log_lines": F.log1p(lines.cast("double")),
        "word_length": F.col("chars") / (words + 1),
        "line_words": words / lines,
        "distinct": F.size("features") / (words + 1),
    }
    return raw.select("id", "text_key", "features", "wide", *_SIGNS, *[c for c in more if c.startswith("cat")], *[c.alias(n) for n, c in shape.items()])


class _View:
    """A logistic regression over one view of the documents."""

    def __init__(self, kind: str, columns: list[str]):
        self.kind, self.model = kind, None
        # The text view's words are known once it has chosen them.
        self.vectors = FeatureHasher(inputCols=columns, outputCol="x", numFeatures=META_BUCKETS) if kind == "meta" else None
        self.telling = np.array([], np.int32)

    def _choose(self, train: DataFrame) -> None:
        """Take the words that tell the classes apart best; a vector has a place for each of these, not for each bucket."""
        # The bucket -1 counts all rows, so that one pass is enough.
        each = train.select("y", F.explode(F.array_append("features", F.lit(-1))).alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("good"))
        each = written(each, "words")
        n, good = each.where("w = -1").select("n", "good").first()
        share = good / n
        apart = (F.col("good") - F.col("n") * share) * (F.col("good") - F.col("n") * share) / (F.col("n") * (share * (1 - share)))
        best = each.where((F.col("w") >= 0) & (F.col("n") >= LEAST_DOCS)).orderBy(apart.desc(), "w").limit(TELLING).select("w").collect()
        forget(each)
        self.telling = np.array([r.w for r in best], np.int32)
        self.vectors = CountVectorizerModel.from_vocabulary([str(r.w) for r in best] or ["none"], inputCol="words", outputCol="x", binary=True)

    def _vectors(self, rows: DataFrame) -> DataFrame:
        if self.kind == "text":
            rows = rows.withColumn("words", F.array_intersect("features", F.lit(self.telling)).cast("array<string>"))
        return self.vectors.transform(rows).drop("words")

    def fit(self, train: DataFrame) -> None:
        """`train` has the columns of view_features and y. Vectors are written, as a fit reads them several times."""
        if self.kind == "text":
            self._choose(train)
        # Words share a penalty as they are; the measures of the metadata differ in scale.
        learner = LogisticRegression(featuresCol="x", labelCol="y", maxIter=40, regParam=0.001, standardization=self.kind == "meta")
        rows = written(self._vectors(train).select("x", "y"), "vectors")
        self.model = learner.fit(rows)
        forget(rows)

    def scored(self, rows: DataFrame, name: str) -> DataFrame:
        model = self.model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
        return model.transform(self._vectors(rows)).withColumn(name, vector_to_array("_p")[1]).drop("_p", "x")


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _calibration(scored: DataFrame, name: str) -> tuple[float, float]:
    """(slope, intercept) of the logit of a view's probability that fit the labels best; the slope is not negative."""
    rows = VectorAssembler(inputCols=["l"], outputCol="x").transform(scored.select(_logit(F.col(name)).alias("l"), "y"))
    model = LogisticRegression(featuresCol="x", labelCol="y", maxIter=50, regParam=1e-4).fit(rows.select("x", "y"))
    return max(float(model.coefficients[0]), 0.0), float(model.intercept)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "label",
    category_cols: tuple[str, ...] = ("source", "lang"),
    rounds: int = ROUNDS,
    keep: float | None = None,
    good_share: float = GOOD_SHARE,
) -> DataFrame:
    """One row per row: doc_id, p_text, p_meta, score, keep.

    `labels` has 1 for good and 0 for poor documents by id; null ids and labels are left out, and of several
    labels of one id the smallest counts. A quarter of them, by a hash of the id, calibrates; all others are fitted on.
    Each round adds to each view all documents without a label of which the other is confident. `score` is the probability
    of good from both calibrated views, `keep` whether it is at least `keep`, by default the highest score that `good_share` of
    the good documents kept apart reach. Null, empty and very long texts are scored like others; equal rows alike. Null
    categories count as missing. Without labels of both classes all get the share of good labels (0.5
    without any). Further columns are ignored. An empty table gives no rows.
    """
    known = labels.select(column(labels, label_id_col).alias("id"), column(labels, label_col).cast("double").alias("y"))
    known = known.where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    # Labels grow with the documents: a broadcast would do for small tables only.
    rows = written(view_features(docs, id_col, text_col, category_cols).join(known.hint("merge"), "id", "left"), "features")
    held = F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2
    train, apart = rows.where(F.col("y").isNotNull() & ~held), rows.where(F.col("y").isNotNull() & held)
    classes = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    if len(classes) < 2:
        share = F.lit(float(next(iter(classes), 0.5)))
        out = rows.select(F.col("id").alias("doc_id"), share.alias("p_text"), share.alias("p_meta"), share.alias("score"))
        return out.withColumn("keep", F.col("score") >= (KEEP if keep is None else keep))
    meta = [c for c in rows.columns if c not in ("id", "text_key", "features", "y")]
    views = {"text": _View("text", meta), "meta": _View("meta", meta)}
    taught = {"text": train, "meta": train}
    for turn in range(rounds + 1):
        for kind, view in views.items():
            view.fit(taught[kind])
        if turn == rounds:
            break
        # A row's pseudo-label is read off its own score of the other view, whose model is that of this turn.
        for kind, other in (("text", "meta"), ("meta", "text")):
            p = F.col("p_other")
            scored = views[other].scored(rows.where("y is null"), "p_other").where((p >= 1 - CONFIDENT) | (p <= CONFIDENT))
            pseudo = scored.withColumn("y", F.when(p >= 1 - CONFIDENT, 1.0).otherwise(0.0)).select(*rows.columns)
            taught[kind] = train.unionByName(pseudo)
    prior = classes.get(1.0, 0) / sum(classes.values())
    base = math.log(prior / (1 - prior))
    logits = []
    for kind, view in views.items():
        sample = written(view.scored(apart, "p").select("p", "y"), "calibration")
        two = sample.select("y").distinct().count() == 2
        slope, intercept = _calibration(sample, "p") if two else (1.0, 0.0)
        forget(sample)
        logits.append((kind, _logit(F.col(f"raw_{kind}")) * slope + intercept))
    scored = views["text"].scored(views["meta"].scored(rows, "raw_meta"), "raw_text")
    # The views count as independent given the class: their evidence adds up beyond the prior.
    total = logits[0][1] + logits[1][1] - base
    good = {kind: 1 / (1 + F.exp(-x)) for kind, x in logits}
    if keep is None:
        kept_apart = views["text"].scored(views["meta"].scored(apart.where("y = 1"), "raw_meta"), "raw_text")
        least = exact_quantiles(kept_apart.select((1 / (1 + F.exp(-total))).alias("score")), "score", [1 - good_share]).first()
        keep = KEEP if least is None else least["value"]
    out = scored.select(
        F.col("id").alias("doc_id"),
        good["text"].alias("p_text"),
        good["meta"].alias("p_meta"),
        (1 / (1 + F.exp(-total))).alias("score"),
    )
    return out.withColumn("keep", F.col("score") >= keep)


def good_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of a table of quality and toxic marks: 1 where quality is 1 and toxic is not 1."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    return labels.select(column(labels, id_col).alias("doc_id"), good.cast("int").alias("label"))
