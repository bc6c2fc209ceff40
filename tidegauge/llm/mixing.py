"""Mixing to target weights with soft memberships, in DataFrame functions only.

A classifier fitted on a labelled table predicts how far each document belongs to each domain. Projected
gradient steps then fit nonnegative rates of the documents by least squares, so that the expected tokens of
each domain meet their targets. The gradient of a document's rate is the misses of the targets weighted by its
posteriors; a step scales it by the curvature over the documents with a positive rate and projects onto rates
of 0 and more. A rate so depends on the posteriors alone, and the steps run over the cells of a grid of
posteriors with their tokens and mean posteriors, a table that stops growing with the corpus. The grid only groups: sums over
cells of tokens x mean x rate are those over documents of tokens x posterior x rate.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, share_of, written

#: Hashed features, at most so many rows of the classifier are broadcast.
BUCKETS = 1 << 17
#: Labelled documents that are fitted on, about; their ids are broadcast.
FIT_ROWS = 50_000
#: A feature counts if so many labelled documents have it and its domains differ by so much (chi-square).
LEAST_DOCS, LEAST_CHI2 = 10, 16.0
TEMPERATURES = (1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05, 0.03)
#: Steps of a posterior on the grid.
GRID = 64
#: Weight of keeping rates near 1 against meeting targets; change of the loss to stop at; steps at most.
RIDGE, TOLERANCE, STEPS = 1e-4, 1e-9, 50
#: Cells are broadcast to the documents up to so many, and joined by shuffle beyond.
BROADCAST_CELLS = 200_000


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s]+", " ")), " ")


def _feature(word: Column) -> Column:
    """A word in lower case, or the signs that it ends with other than a full stop or comma; as a bucket."""
    last = F.ascii(F.right(word, F.lit(1)))
    sign = ((last >= 33) & (last <= 47) & ~last.isin(44, 46)) | ((last >= 58) & (last <= 64)) | (last >= 123) & (last <= 126)
    named = F.when(sign, F.right(word, F.lit(2))).otherwise(F.lower(word))
    return F.pmod(F.xxhash64(named), F.lit(BUCKETS)).cast("int")


def document_features(docs: DataFrame, id_col: str, text_col: str, more: dict[str, Column] | None = None) -> DataFrame:
    """id, text_key, tokens (words of the whole text), features (buckets of its distinct words) and `more`."""
    text = column(docs, text_col)
    cut = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(text).alias("text_key"),
        _words(text).alias("words"),
        *[c.alias(name) for name, c in (more or {}).items()],
    )
    blank = (F.size("words") == 1) & (F.col("words")[0] == "")
    return cut.select(
        "id",
        "text_key",
        F.when(blank, 0).otherwise(F.size("words")).cast("long").alias("tokens"),
        F.when(blank, F.array().cast("array<int>"))
        .otherwise(F.transform(F.array_distinct("words"), _feature))
        .alias("features"),
        *(more or {}),
    )


class Classifier:
    """Evidence of each feature for each domain, priors and a temperature that calibrates the posteriors."""

    def __init__(self, names: list[str], priors: list[float], weights: DataFrame, temperature: float = 1.0):
        self.names, self.priors, self.weights, self.temperature = names, priors, weights, temperature

    def evidence(self, features: DataFrame) -> DataFrame:
        """The columns of `features` other than the features, and e0, e1, ...: the summed evidence."""
        keys = [c for c in features.columns if c != "features"]
        # The bucket -1 is in the weights, with no evidence, so that every document has a row.
        rows = features.withColumn("_row", F.monotonically_increasing_id())
        each = rows.select(*keys, "_row", F.explode(F.array_append("features", F.lit(-1))).alias("feature"))
        sums = [F.sum(f"w{k}").alias(f"e{k}") for k in range(len(self.names))]
        return each.join(F.broadcast(self.weights), "feature").groupBy("_row", *keys).agg(*sums).drop("_row")

    def logits(self, temperature: float) -> list[Column]:
        return [F.lit(math.log(p)) + F.col(f"e{k}") * temperature for k, p in enumerate(self.priors)]

    def posteriors(self, temperature: float | None = None) -> list[Column]:
        """Posterior of each domain, from the columns e0, e1, ..."""
        logits = self.logits(self.temperature if temperature is None else temperature)
        top = F.greatest(*logits) if len(logits) > 1 else logits[0]
        parts = [F.exp(x - top) for x in logits]
        total = sum(parts[1:], parts[0])
        return [p / total for p in parts]


def fit_classifier(
    features: DataFrame, labelled: DataFrame, id_col: str = "doc_id", domain_col: str = "domain", fit_rows: int = FIT_ROWS
) -> Classifier:
    """Fit on the rows of `labelled` (id, domain) that have features, or a hash sample of about `fit_rows`.

    A quarter of them, by a hash of the id, calibrates.

    Null ids and domains are left out; of several domains of one id the first in order counts. Without any
    labelled rows there is one domain, `unknown`.
    """
    known = labelled.select(column(labelled, id_col).alias("id"), column(labelled, domain_col).cast("string").alias("domain"))
    known = known.where("id is not null and domain is not null").groupBy("id").agg(F.min("domain").alias("domain"))
    known = share_of(written(known, "known"), fit_rows, "id")
    rows = written(features.join(F.broadcast(known), "id").select("id", "domain", "features"), "labelled")
    held = F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2
    sizes = rows.where(~held).groupBy("domain").count().orderBy("domain").collect()  # a row a domain, of the bounded sample
    spark = features.sparkSession
    if not sizes:
        return Classifier(["unknown"], [1.0], spark.createDataFrame([(-1, 0.0)], "feature int, w0 double"))
    names, n = [r.domain for r in sizes], [r["count"] for r in sizes]
    total = sum(n)
    counts = (
        rows.where(~held)
        .select("domain", F.explode(F.array_distinct("features")).alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("c"), *[F.count_if(F.col("domain") == x).alias(f"c{k}") for k, x in enumerate(names)])
        .where(F.col("c") >= LEAST_DOCS)
    )
    expected = [F.col("c") * (size / total) for size in n]
    chi2 = [(F.col(f"c{k}") - e) * (F.col(f"c{k}") - e) / e for k, e in enumerate(expected)]
    told = counts.where((F.greatest(*chi2) if len(chi2) > 1 else chi2[0]) >= LEAST_CHI2)
    background = F.log((F.col("c") + 1) / (total + 2))
    weights = told.select(
        "feature", *[(F.log((F.col(f"c{k}") + 1) / (size + 2)) - background).alias(f"w{k}") for k, size in enumerate(n)]
    )
    none = spark.createDataFrame([(-1, *[0.0] * len(n))], weights.schema)
    found = Classifier(names, [size / total for size in n], written(weights.union(none), "weights"))
    scored = found.evidence(rows.where(held).select("domain", "features"))
    right = [F.when(F.col("domain") == x, F.lit(k)) for k, x in enumerate(names)]
    place = F.coalesce(*right)
    losses = []
    for i, t in enumerate(TEMPERATURES):
        p = F.element_at(F.array(*found.posteriors(t)), place + 1)
        losses.append(F.avg(-F.log(F.greatest(p, F.lit(1e-12)))).alias(f"t{i}"))
    loss = scored.where(place.isNotNull()).agg(*losses).first()
    if loss[0] is not None:
        found.temperature = TEMPERATURES[int(np.argmin(list(loss)))]
    return found


def _rate(p: list[Column], push: np.ndarray) -> Column:
    """The rate of a cell of posteriors `p` after steps that add up to `push`: 1 minus its share of them, projected."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((x * float(y) for x, y in zip(p, push, strict=True)), F.lit(0.0)))


def fit_rates(cells: DataFrame, names: list[str], targets: dict[str, float], total: float) -> DataFrame:
    """`cells` (q0, q1, ... of GRID, tokens) with a rate each; m0, m1, ... are their mean posteriors, or else those of the grid.

    Minimises the sum over domains of (expected tokens - target)^2 / tokens now, plus RIDGE times the sum of
    tokens x (rate - 1)^2, over rates >= 0. Targets out of reach get the nearest mix. Each step is two passes over
    the cells, whose sums the driver gets: a few numbers for each pair of domains.
    """
    n = len(names)
    p = [F.col(f"m{i}") if f"m{i}" in cells.columns else F.col(f"q{i}") / GRID for i in range(n)]
    cells = written(cells, "cells")
    have = np.array([x or 0.0 for x in cells.agg(*[F.sum(F.col("tokens") * x) for x in p]).first()])
    want = np.array([targets.get(x, 0.0) for x in names])
    want = want / max(want.sum(), 1e-300) * total
    ridge = RIDGE * np.maximum(have, 1e-9 * max(total, 1.0))
    push = np.zeros(n)

    def losses(tries: list[np.ndarray]) -> list[float]:
        # The dual of the problem, which the steps lower: see the docstring for the problem itself.
        sums = cells.agg(*[F.sum(F.col("tokens") * _rate(p, t) * _rate(p, t) / 2) for t in tries]).first()
        return [(x or 0.0) + float(want @ t) + float(ridge @ (t * t)) / 2 for x, t in zip(sums, tries, strict=True)]

    for _ in range(STEPS):
        rate = _rate(p, push)
        live = F.col("tokens") * (rate > 0).cast("double")
        sums = [F.sum(F.col("tokens") * x * rate) for x in p] + [F.sum(live * x * y) for x in p for y in p]
        row = np.array([x or 0.0 for x in cells.agg(*sums).first()])
        gradient = row[:n] - want - ridge * push
        move = np.linalg.solve(row[n:].reshape(n, n) + np.diag(ridge), gradient)
        tries = [push + move * 0.5**i for i in range(8)]
        found = losses([push, *tries])
        least = int(np.argmin(found))
        if least == 0 or found[0] - found[least] <= TOLERANCE * max(total, 1.0):
            break
        push = tries[least - 1]
    return cells.withColumn("rate", _rate(p, push))


def document_rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    domain_col: str = "domain",
    budget: float = 1.0,
) -> DataFrame:
    """One row per row: doc_id, text_key, tokens, p_<domain> of each domain, rate, copies.

    `targets` are weights of domains, missing ones 0; all tokens of the mix together are to be `budget` times
    those now. A budget above 1 keeps documents of a domain whose weight is to grow in the mix at least once.
    Expected tokens of a domain are the sum of tokens x posterior x rate. `copies` is the rate rounded up or
    down by a hash of the document, so that it is right on average and the same in every run. Null, empty and
    blank texts have no tokens and get the posteriors that the priors give. Null ids and repeated rows are
    mixed like others, equal rows alike. Texts are read whole. Further columns are ignored. An empty table gives no rows.
    """
    features = written(document_features(docs, id_col, text_col), "features")
    model = fit_classifier(features, labelled, label_id_col, domain_col)
    names = model.names
    scored = model.evidence(features)
    keys = ["id", "text_key", "tokens"]
    # Rounded to the grid with the largest remainder on the largest posterior, so that cells sum to GRID.
    exact = scored.select(*keys, *[x.alias(f"p{i}") for i, x in enumerate(model.posteriors())])
    down = [F.floor(F.col(f"p{i}") * GRID).cast("int") for i in range(len(names))]
    rest = F.lit(GRID) - sum(down[1:], down[0])
    top = F.array_position(F.array(*[F.col(f"p{i}") for i in range(len(names))]), F.greatest(*[F.col(f"p{i}") for i in range(len(names))]) if len(names) > 1 else F.col("p0"))
    gridded = exact.select("*", *[(down[i] + F.when(top == i + 1, rest).otherwise(0)).alias(f"q{i}") for i in range(len(names))])
    gridded = written(gridded, "posteriors")
    q = [f"q{i}" for i in range(len(names))]
    # Weighted by tokens; cells without tokens have no part in the sums and go by the grid.
    means = [F.coalesce(F.try_divide(F.sum(F.col("tokens") * F.col(f"p{i}")), F.sum("tokens")), F.first(f"q{i}") / GRID).alias(f"m{i}") for i in range(len(names))]
    cells = gridded.groupBy(*q).agg(F.sum("tokens").alias("tokens"), *means)
    total = float(gridded.agg(F.sum("tokens")).first()[0] or 0)
    rates = fit_rates(cells, names, targets, total * budget).select(*q, "rate")
    small = rates.count() <= BROADCAST_CELLS
    out = gridded.join(F.broadcast(rates) if small else rates, q)
    spot = F.pmod(F.xxhash64("id", "text_key"), F.lit(1 << 30)) / (1 << 30)
    copies = (F.floor("rate") + (spot < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    return out.select(
        F.col("id").alias("doc_id"),
        "text_key",
        "tokens",
        *[F.col(f"p{i}").alias(f"p_{x}") for i, x in enumerate(names)],
        "rate",
        copies.alias("copies"),
    )


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """`docs` with each row as often as its rate says; same columns."""
    rates = document_rates(docs, labelled, targets, id_col, text_col, **params)
    rates = rates.select("doc_id", "text_key", "copies").dropDuplicates(["doc_id", "text_key"])
    rows = docs.select(
        F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("row"), column(docs, id_col).alias("_id"), F.xxhash64(column(docs, text_col)).alias("_key")
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))
    return rows.join(rates, same).where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, domain) of a table of quality and toxic marks: toxic, else good or poor."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select(column(labels, id_col).alias("doc_id"), domain.alias("domain")).where("domain is not null")
