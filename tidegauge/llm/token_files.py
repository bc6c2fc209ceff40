"""Token ids in Arrow files of fixed-size-list batches, for zero-copy random access.

A shard holds the documents of one range of ids in ascending order, their ids one after the other, cut
into sequences of equal length. `<shard>.arrow` is an Arrow IPC file (the stream format with a footer)
with the columns `tokens` (fixed-size list of the narrowest unsigned type that fits the vocabulary) and
`mask` (fixed-size list of booleans, false in the padding at a shard's end); its batches have the same
number of sequences, so sequence i lies in batch i // batch_sequences and is read without copying or
searching. `<shard>.docs.arrow` has doc_id, start and n_tokens of each document within the shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import column, mapped, written
from tidegauge.llm.tokens import documents_ids
from tidegauge.session import scratch_path

SEQUENCE = 2048
BATCH_SEQUENCES = 512
DOCS_PER_SHARD = 16_384

_MANIFEST = "shard int, file string, n_docs long, n_tokens long, n_sequences long"


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """(file system, path) of a folder on storage that executors share: file:, hdfs:, s3: and others."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if uri.startswith("/"):
        uri = "file://" + uri
    return arrow_fs.FileSystem.from_uri(uri)


def crc32_ids(ids: np.ndarray, crc: int = 0) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers, carried on from `crc`."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)


class _ShardWriter:
    def __init__(self, fs, path: str, width, length: int, batch: int, id_type: pa.DataType):
        self.fs, self.path, self.length, self.batch = fs, path, length, batch
        self.attempt = f"{path}.{TaskContext.get().taskAttemptId()}.part"
        kind = pa.from_numpy_dtype(width)
        self.schema = pa.schema([("tokens", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = [fs.open_output_stream(self.attempt), fs.open_output_stream(self.attempt + ".docs")]
        self.tokens = pa.ipc.new_file(self.out[0], self.schema)
        self.docs = pa.ipc.new_file(self.out[1], self.docs_schema)
        self.pending: list[np.ndarray] = []
        self.held = self.n_tokens = self.n_docs = self.n_sequences = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> None:
        start = pa.array(self.n_tokens + offsets[:-1], pa.int64())
        self.docs.write_batch(pa.record_batch([doc_ids, start, pa.array(np.diff(offsets), pa.int64())], schema=self.docs_schema))
        self.pending.append(ids)
        self.n_tokens, self.n_docs, self.held = self.n_tokens + len(ids), self.n_docs + len(doc_ids), self.held + len(ids)
        block = self.length * self.batch
        if self.held >= block:
            whole = np.concatenate(self.pending)
            for at in range(0, len(whole) - block + 1, block):
                self._batch(whole[at : at + block], block)
            rest = whole[len(whole) // block * block :].copy()
            self.pending, self.held = [rest], len(rest)

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.tokens.write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += len(ids) // self.length

    def close(self) -> None:
        if self.held:
            ids = np.concatenate(self.pending)
            self._batch(np.pad(ids, (0, -len(ids) % self.length)), len(ids))
        for x in (self.tokens, self.docs, *self.out):
            x.close()
        # A file appears whole or not at all; a repeated attempt writes the same bytes.
        self.fs.move(self.attempt + ".docs", self.path + ".docs.arrow")
        self.fs.move(self.attempt, self.path + ".arrow")


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    batch_sequences: int = BATCH_SEQUENCES,
    docs_per_shard: int = DOCS_PER_SHARD,
) -> DataFrame:
    """Write every whole text as ids and return the manifest: shard, file, n_docs, n_tokens, n_sequences.

    `tokenizer` is a tokenizer file that every executor can read; `folder` (by default a new one in the
    shared scratch folder) is a URI that Arrow can open. Documents are in ascending order of id, null ids
    first; those of one id are ordered by a hash of their text, so repeated ids and rows are all kept. Null
    and empty texts give the end id alone. A text of any length is read whole; sequences run across
    documents. Further columns are ignored. An empty table gives an empty manifest and no files.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    slim = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    shards = max(1, -(-slim.count() // docs_per_shard))
    order = ["doc_id", F.xxhash64("text")]
    ranged = slim.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidegauge.llm.tokens import encoder

        fs, path = open_folder(folder)
        shard = TaskContext.get().partitionId()
        out = None
        for rows, ids, offsets in documents_ids(batches, tokenizer, "text"):
            if out is None:
                name = f"shard-{shard:06d}"
                width = encoder(tokenizer).width
                out = _ShardWriter(fs, f"{path}/{name}", width, sequence, batch_sequences, rows.schema.field("doc_id").type)
            out.add(rows.column(0), ids, offsets)
        if out is not None:
            out.close()
            row = [[shard], [name], [out.n_docs], [out.n_tokens], [out.n_sequences]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["shard", "file", "n_docs", "n_tokens", "n_sequences"])

    done = written(mapped(ranged, write, _MANIFEST), "manifest")
    return done.select("*", F.lit(folder).alias("folder"))


class TokenFile:
    """One shard, opened for random access. `sequence(i)` gives ids and mask of sequence i as views."""

    def __init__(self, folder: str, name: str):
        fs, path = open_folder(folder)
        local = isinstance(fs, arrow_fs.LocalFileSystem)
        self.source = [pa.memory_map(f"{path}/{name}{x}") if local else fs.open_input_file(f"{path}/{name}{x}") for x in (".arrow", ".docs.arrow")]
        self.reader, self.docs_reader = (pa.ipc.open_file(x) for x in self.source)
        self.length = self.reader.schema.field("tokens").type.list_size
        self.per_batch = len(self.reader.get_batch(0)) if self.reader.num_record_batches else 1

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        batch, at = self.reader.get_batch(i // self.per_batch), i % self.per_batch
        return batch.column(0)[at].values.to_numpy(zero_copy_only=True), batch.column(1)[at].values

    def span(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids at places start to stop of the shard, as views into its batches."""
        block = self.per_batch * self.length
        while start < stop:
            batch = self.reader.get_batch(start // block).column(0)
            part = batch.flatten().to_numpy(zero_copy_only=True)[start % block : start % block + stop - start]
            yield part
            start += len(part)

    def documents(self) -> Iterator[pa.RecordBatch]:
        return (self.docs_reader.get_batch(i) for i in range(self.docs_reader.num_record_batches))

    def real_tokens(self) -> int:
        """Places that the masks mark as tokens."""
        return sum(self.reader.get_batch(i).column(1).flatten().true_count for i in range(self.reader.num_record_batches))


def read_token_files(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32, shard.

    `start` counts the ids of all documents before it, over all shards. The running sum sorts one row per
    shard, not per document. A shard whose masks disagree with its documents raises an error.
    """
    base = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = written(manifest.select("shard", "file", "folder", "n_tokens", F.coalesce(base, F.lit(0)).alias("base")), "places")
    shards = max(1, placed.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in (row for batch in batches for row in batch.to_pylist()):
            file = TokenFile(shard["folder"], shard["file"])
            if file.real_tokens() != shard["n_tokens"]:
                raise ValueError(f"{shard['file']}: masks and documents disagree")
            for docs in file.documents():
                start, count = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                crcs = []
                for a, n in zip(start.tolist(), count.tolist(), strict=True):
                    crc = 0
                    for part in file.span(a, a + n):
                        crc = crc32_ids(part, crc)
                    crcs.append(crc)
                columns = [docs.column(0), pa.array(start + shard["base"]), docs.column(2), pa.array(crcs, pa.int64()), pa.array([shard["shard"]] * len(docs), pa.int32())]
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, shard int"
    return placed.repartitionByRange(shards, "shard").mapInArrow(read, schema)


def token_digest(spark: SparkSession, docs: DataFrame, tokenizer: str, **params) -> DataFrame:
    """Write `docs` and read them back."""
    kind = docs.schema[params.get("id_col", "doc_id")].dataType.simpleString()
    return read_token_files(write_token_files(docs, tokenizer, **params), kind)
