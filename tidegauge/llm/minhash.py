"""Word shingles, MinHash signatures and exact verification of colliding texts, for whole batches at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from tidegauge.llm.units import LINKS, Unit, linked_rows, per_unit

SHINGLE = 5
THRESHOLD = 0.8
#: Shingles that are hashed at a time: what fits a processor's cache.
CHUNK = 1 << 10

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * _Q
    x = (x ^ (x >> np.uint64(29))) * _Q
    return x ^ (x >> np.uint64(32))


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all word shingles, text by text and with repeats; offsets of the texts in them).

    Words are what white space parts, in lower case. A text of fewer words than `size` has one shingle of all
    of them; a text without words, or null, has none.
    """
    # Arrow's split looks at the byte after white space that ends a text, and at memory that is not its own after the last: one text more ends the column.
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), ""), pa.array(["."], pa.large_string())])
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts))[:-1]
    words, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # white space at a text's ends leaves empty words
    ends = np.concatenate([[0], np.cumsum(real)])[ends]
    words = words.filter(pa.array(real)).dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    word = distinct[words.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    count = np.diff(ends)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(word) - size + 1), np.uint64)
        for k in range(size):
            rolled = rolled * _P + word[k : k + len(rolled)]
        have = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        offsets = np.concatenate([[0], np.cumsum(have)])
        of = np.repeat(np.arange(len(count)), have)
        at = ends[:-1][of] + np.arange(len(of)) - offsets[:-1][of]
        out = np.zeros(len(of), np.uint64)
        long = count[of] >= size
        out[long] = rolled[at[long]]
        for i in np.flatnonzero(~long):
            value = np.uint64(count[of[i]])
            for w in word[at[i] : at[i] + count[of[i]]]:
                value = value * _P + w
            out[i] = value
        return mixed(out), offsets


def signatures(hashes: np.ndarray, offsets: np.ndarray, perms: int, seed: int = 7) -> np.ndarray:
    """MinHash values (texts x perms, 32 bits each); a text without shingles has the largest value throughout."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 32, perms, np.uint64).astype(np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, perms, np.uint64).astype(np.uint32)
    out = np.full((len(offsets) - 1, perms), np.iinfo(np.uint32).max, np.uint32)
    low = hashes.astype(np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    for start in range(0, len(low), CHUNK):
        stop = min(start + CHUNK, len(low))
        # Texts with a part in this chunk.
        first, last = np.searchsorted(offsets[full + 1], start, "right"), np.searchsorted(offsets[full], stop, "left")
        rows = full[first:last]
        with np.errstate(over="ignore"):
            values = low[start:stop, None] * a + b
        values ^= values >> np.uint32(15)
        least = np.minimum.reduceat(values, np.maximum(offsets[rows] - start, 0), axis=0)
        out[rows] = np.minimum(out[rows], least)
    return out


def bucket_keys(signature: np.ndarray, depth: int) -> np.ndarray:
    """(texts x tables) 64-bit names of the buckets: the first `depth` values of each table's part.

    `signature` is texts x tables x values. Buckets of different tables have different names.
    """
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, signature.shape[1] + 1, dtype=np.uint64) * _Q, signature.shape[:2]).copy()
        for k in range(depth):
            key = mixed(key * _P + signature[:, :, k])
    return key.view(np.int64)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, each an array of distinct numbers."""
    size = np.array([len(s) for s in sets])
    values, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(values, kind="stable")
    values, of = values[order], of[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    run = np.cumsum(new) - 1
    shared = np.bincount(run)[run] > 1
    of, run = of[shared], run[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    if len(run):
        run = np.cumsum(np.concatenate([[0], (run[1:] != run[:-1]).astype(np.int64)]))
        for start in range(0, int(run[-1]) + 1, 4096):
            a, b = np.searchsorted(run, [start, start + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[of[a:b], run[a:b] - start] = 1
            out += part @ part.T  # exact: sums of ones below 2^24
    return out


def _sharing(keys: np.ndarray) -> np.ndarray:
    """Which members (row and column) share a bucket in some table."""
    out = np.zeros((len(keys), len(keys)), bool)
    for t in range(keys.shape[1]):
        out |= keys[:, None, t] == keys[None, :, t]
    return out


def verified(units: DataFrame, payload: DataFrame, threshold: float, buckets_of: Callable) -> DataFrame:
    """Verified links, counted: (cid, links, root, low), several rows a class.

    `units` as from collisions() or gathered(); `payload` has for each cid the copies of its text, its set of shingles
    (bytes of 64-bit numbers), whether it is `active` if pairs of others are not wanted, and what `buckets_of(unit)` needs
    for two arrays: the members' buckets by table, and those in which their pairs were verified before, if any. A
    pair counts in the first table in which it shares a bucket, or in the unit of its leader. `links` counts linked texts with their
    copies, `root` is the smallest cid linked with it in the unit and `low` the least similarity of its links there.
    """

    def check(unit: Unit) -> dict[str, list]:
        sets = [np.frombuffer(s, np.uint64) for s in unit["shingles"]]
        keys, prior = buckets_of(unit)
        todo = unit.pairs()
        if "active" in unit:
            active = np.array(unit["active"], bool)
            todo &= active[:, None] | active[None, :]
        table = int(unit["table"][0])
        if table < 0:
            todo &= _sharing(keys)
        elif "leader" in unit:
            todo &= unit["leader"][:, None] != unit["leader"][None, :]
        for t in range(table):
            todo &= keys[:, None, t] != keys[None, :, t]
        for t in range(prior.shape[1]):
            todo &= prior[:, None, t] != prior[None, :, t]
        if not todo.any():
            return {}
        size = np.array([len(s) for s in sets], np.float64)
        both = overlaps(sets).astype(np.float64)
        alike = both / np.maximum(size[:, None] + size[None, :] - both, 1)
        a, b = np.nonzero(todo & (alike >= threshold))
        out = linked_rows(unit, a, b)
        if out:
            low = np.full(len(size), 2.0)
            np.minimum.at(low, np.concatenate([a, b]), np.concatenate([alike[a, b]] * 2))
            out["low"] = low[low < 2].tolist()
        return out

    return per_unit(units.join(payload, "cid"), check, f"{LINKS}, low double")


def bucket_rows(cid: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """(cid, table, bucket), a row for each table of each text."""
    tables = keys.shape[1]
    columns = [pa.array(np.repeat(cid, tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(cid))), pa.array(keys.reshape(-1))]
    return pa.record_batch(columns, names=["cid", "table", "bucket"])


BUCKETS = "cid long, table int, bucket long"


def slices_of(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches with a bounded amount of text."""
    from tidegauge.llm.tokens import slices

    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text_col))
        for start, stop in slices(texts):
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
