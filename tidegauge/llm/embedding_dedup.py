"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest pivots, a bounded sample of reference vectors, in order of nearness. The
inverted lists are kept for sets of pivots: a vector stands in the list of every set of `shared` of its
nearest pivots, so two vectors meet in a list exactly if they share that many. Who meets is verified by cosine
in double precision. Equal vectors are one class, so copies cost nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import connected_components
from tidegauge.llm.frames import column, mapped, written
from tidegauge.llm.units import LINKS, Unit, collisions, linked_rows, per_unit

THRESHOLD = 0.95
#: Share of the pairs right at the threshold that are to meet, as measured on sampled vectors of the table.
RECALL = 0.99
#: How many nearest pivots describe a vector, and how many of them two vectors must share: tried in this order.
DESCRIPTIONS = ((8, 3), (9, 3), (10, 3), (12, 3), (14, 3))
#: Pivots of a length: four times the root of the number of its distinct vectors, within these bounds. All vectors are indexed.
LEAST_PIVOTS = 64
MOST_PIVOTS = 16_384
#: Bytes of the pivots of all lengths together, which are broadcast; beyond, each length gets fewer.
PIVOT_BYTES = 64 << 20
#: Pivots are to have a cosine of at most this with each other.
APART = 0.8
#: Vectors of a length on which the recall is measured.
MEASURED = 400

_BITS = 21  # of a pivot's number; three of them name a list


def _unit_vectors(rows: DataFrame) -> DataFrame:
    """id, digest and unit vector (bytes of doubles) of each (id, vector); null for vectors that link with nothing."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, units = [], []
            for value in batch.column(1).to_pylist():
                x = np.array([np.nan if v is None else v for v in value] if value else [], np.float64) + 0.0
                top = np.abs(x).max() if len(x) else 0.0
                good = 0 < top < np.inf  # false for NaN
                if good:
                    x = x / top  # so that squares neither overflow nor vanish
                    x = x / math.sqrt(float(x @ x))
                units.append(x.tobytes() if good else None)
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if good else None)
            yield pa.record_batch([batch.column(0), pa.array(digests, pa.binary()), pa.array(units, pa.binary())], names=["id", "digest", "unit_vector"])

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, scale, f"id {kind}, digest binary, unit_vector binary")


def _spread(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Up to `pivots` of the vectors that lie apart; with fewer than LEAST_PIVOTS of them, others fill up.

    A large group of near copies would otherwise bring many pivots that its members cannot tell apart.
    """
    kept, rest = np.empty_like(vectors), []
    n = 0
    for i, x in enumerate(vectors):
        if n == pivots:
            break
        if n and (kept[:n] @ x).max() > APART:
            rest.append(i)
        else:
            kept[n] = x
            n += 1
    return np.concatenate([kept[:n], vectors[rest[: max(0, min(pivots, LEAST_PIVOTS) - n)]]])


def choose_pivots(classes: DataFrame, pivots: int | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors its pivots, and a few vectors to measure by.

    Candidates are the vectors of smallest hash, by a bound on the hash, some three for each pivot; they are brought
    together and thinned in a task for each length. The driver gets the pivots.
    """
    sizes = classes.groupBy(F.octet_length("unit_vector").alias("bytes")).agg(F.count("*").alias("n")).collect()  # a row a length
    wanted = {r["bytes"]: pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(4 * math.sqrt(r["n"])))) for r in sizes}
    fewer = min(1.0, PIVOT_BYTES / max(1, sum(size * min(many, n) for (size, many), n in zip(wanted.items(), [r["n"] for r in sizes], strict=True))))
    plan = [(r["bytes"], max(1, int(wanted[r["bytes"]] * fewer)), min(1.0, 3 * max(MEASURED, wanted[r["bytes"]]) / r["n"])) for r in sizes]
    if not plan:
        return {}
    spark = classes.sparkSession
    grain = 1 << 40
    shares = spark.createDataFrame([(size, many, int(share * grain)) for size, many, share in plan], "bytes int, many int, bound long")
    draw = F.pmod(F.xxhash64("digest"), F.lit(grain))
    sized = classes.select("digest", "unit_vector", F.octet_length("unit_vector").alias("bytes"), draw.alias("draw"))
    some = sized.join(F.broadcast(shares), "bytes").where("draw < bound").select("bytes", "many", "digest", "unit_vector")

    def thin(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("digest")  # the same pivots whenever the task is run
        vectors = np.stack([np.frombuffer(v, np.float64) for v in rows["unit_vector"]])
        kept = [x.tobytes() for x in _spread(vectors, int(rows["many"].iloc[0]))]
        tried = [x.tobytes() for x in vectors[-MEASURED:]]
        return pd.DataFrame({"bytes": rows["bytes"].iloc[0], "pivot": [True] * len(kept) + [False] * len(tried), "vector": kept + tried})

    found = some.groupBy("bytes").applyInPandas(thin, "bytes int, pivot boolean, vector binary").collect()
    out = {}
    for size in wanted:
        mine = [[np.frombuffer(r["vector"], np.float64) for r in found if r["bytes"] == size and r["pivot"] == kind] for kind in (True, False)]
        if mine[0]:
            out[size // 8] = (np.stack(mine[0]), np.stack(mine[1]))
    return out


def measured_recall(tried: np.ndarray, pivots: np.ndarray, threshold: float, choices: tuple[tuple[int, int], ...]) -> list[float]:
    """Share of pairs at the threshold that would meet by each description: each vector with one turned away from it at random."""
    rng = np.random.default_rng(5)
    if tried.shape[1] < 2:
        return [1.0] * len(choices)
    side = rng.normal(size=tried.shape)
    side -= (side * tried).sum(axis=1, keepdims=True) * tried
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    most = max(n for n, _ in choices)
    a, b = (describe(x, pivots, most) for x in (tried, threshold * tried + math.sqrt(1 - threshold**2) * side))
    return [float(np.mean([len(set(x[:n]) & set(y[:n])) >= min(s, len(pivots)) for x, y in zip(a.tolist(), b.tolist(), strict=True)])) for n, s in choices]


def choose_description(pivots: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(nearest, shared): the first of the descriptions that meets pairs at the threshold with this recall in every length, or the last."""
    found = [measured_recall(tried, p, threshold, DESCRIPTIONS) for p, tried in pivots.values()]
    return next((c for i, c in enumerate(DESCRIPTIONS) if all(r[i] >= recall for r in found)), DESCRIPTIONS[-1])


def describe(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Numbers of the nearest pivots of each vector, the nearest first; of equally near ones the lower number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :nearest]


def _indexed(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int, shared: int) -> DataFrame:
    """cid, nearest pivots in ascending order (bytes) and keys, the sets of `shared` of them that name its lists."""
    sent = classes.sparkSession.sparkContext.broadcast(pivots)  # PIVOT_BYTES at most

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            size = np.array([len(r) // 8 for r in raw])
            first, count = {}, 0  # pivots of all lengths are numbered through
            for n, reference in sent.value.items():
                first[n], count = count, count + len(reference)
            for n, reference in sent.value.items():
                for at in np.array_split(np.flatnonzero(size == n), max(1, len(raw) // 512)):
                    if not len(at):
                        continue
                    vectors = np.stack([np.frombuffer(raw[i], np.float64) for i in at])
                    near = np.sort(first[n] + describe(vectors, reference, nearest), axis=1).astype(np.int64)
                    sets = [list(c) for c in combinations(range(near.shape[1]), min(shared, near.shape[1]))]
                    keys = np.zeros((len(at), len(sets)), np.int64)
                    for k, c in enumerate(sets):
                        for i in c:
                            keys[:, k] = (keys[:, k] << _BITS) + near[:, i]
                    yield pa.record_batch(
                        [pa.array(cid[at]), pa.array([x.tobytes() for x in near], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                        names=["cid", "near", "keys"],
                    )

    return mapped(classes.select("cid", "unit_vector"), index, "cid long, near binary, keys array<long>")


def _first_meeting(near: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Pairs whose smallest shared pivots are `of`, so that each pair counts in one of the lists it meets in."""
    other = (near < of[-1]) & ~np.isin(near, of)
    values = np.unique(near[other])
    if not len(values):
        return np.ones((len(near), len(near)), bool)
    has = np.zeros((len(near), len(values)), np.float32)
    row, place = np.nonzero(other)
    has[row, np.searchsorted(values, near[row, place])] = 1
    return has @ has.T == 0


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    nearest: int | None = None,
    shared: int | None = None,
    pivots: int | None = None,
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Two vectors of equal length are linked if their cosine is `threshold` or more. `n_links` counts the other
    rows linked directly, equal vectors included; `component_id` is the smallest id reachable by links and
    `kept` tells whether the row has that id. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, and are their own component. Null ids take part in links and are kept only
    where they reach no other id. Repeated rows are copies of each other. Vectors may be of any lengths.
    Further columns are ignored. An empty table gives no rows.

    Every row is indexed; the pivots alone are a bounded sample. Pairs are missed where fewer than `shared` of
    the `nearest` pivots agree; unless given, these are chosen so that RECALL of the pairs right at the threshold meet.
    """
    rows = vectors.select(column(vectors, id_col).alias("id"), column(vectors, vector_col).alias("vector"))
    scaled = written(_unit_vectors(rows), "vectors")
    classes = scaled.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("unit_vector").alias("unit_vector")
    )
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    chosen = choose_pivots(classes, pivots)
    if nearest is None or shared is None:
        nearest, shared = choose_description(chosen, threshold)
    if not 1 <= shared <= min(3, nearest):
        raise ValueError("shared must be 1 to 3, and no more than nearest")
    index = written(_indexed(classes, {n: p for n, (p, _) in chosen.items()}, nearest, shared), "index")
    units = collisions(index.select("cid", F.lit(0).alias("table"), F.explode("keys").alias("bucket")))
    payload = classes.select("cid", "copies", "unit_vector").join(index.select("cid", "near"), "cid")

    def check(unit: Unit) -> dict[str, list]:
        near = np.stack([np.frombuffer(x, np.int64) for x in unit["near"]])
        bucket, of = int(unit["bucket"][0]), []
        for _ in range(shared):
            of.append(bucket & ((1 << _BITS) - 1))
            bucket >>= _BITS
        todo = unit.pairs() & _first_meeting(near, np.array(of[::-1]))
        if not todo.any():
            return {}
        x = np.stack([np.frombuffer(v, np.float64) for v in unit["unit_vector"]])
        return linked_rows(unit, *np.nonzero(todo & (x @ x.T >= threshold)))

    links = written(per_unit(units.join(payload, "cid"), check, LINKS), "links")
    counted = links.groupBy("cid").agg(F.sum("links").alias("links"))
    group = connected_components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    ids = group.join(classes.select(F.col("cid").alias("node"), "id"), "node")
    named = group.join(ids.groupBy("component").agg(F.min("id").alias("least")), "component")
    whole = (
        classes.select("digest", "cid", "copies", "id")
        .join(counted, "cid", "left")
        .join(named.select(F.col("node").alias("cid"), "least"), "cid", "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least", "id").alias("component_id"),
        )
    )
    linked = scaled.where("digest is not null").select("id", "digest").join(written(whole, "whole"), "digest")
    alone = scaled.where("digest is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (
        linked.select("id", "n_links", "component_id")
        .union(alone)
        .select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
