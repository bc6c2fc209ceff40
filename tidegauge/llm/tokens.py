"""Exact token ids of whole texts, with each distinct piece of text encoded once.

The tokenizer cuts a text into pieces (a run of letters, a digit, a run of signs) and encodes each piece by
itself. A batch of texts therefore costs one encoding per piece not seen before, and array look-ups for
the rest. Texts that hold anything but ASCII and Latin letters are cut at white space only, and their
words go through the tokenizer's full path.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Bytes that the remembered pieces of one Python worker take at most, estimated; when full, the memory starts anew.
REMEMBERED_BYTES = 32_000_000
#: Of a remembered piece besides its characters: a text object, its entry in the table, and its place in the arrays.
PIECE_BYTES = 180
#: Bytes of text that are worked on at a time; the arrays made of them take some thirty times as much.
SLICE_BYTES = 2_000_000
#: Id after each document.
END_ID = 1

#: What sends a text the slower way: other characters, or `<`, which may begin a special token.
_ODD = "[^\\x00-\\x7fÀ-ÖØ-öø-ÿ]|<"
#: Fixed value: the piece pattern of the tokenizer file, for texts in lower case without odd characters.
#: The white space of this engine lacks U+000B, which is none of the signs either.
_CUT = r"('(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-z0-9À-ÖØ-öø-ÿ\s\x0b]+)"
_LETTERS = regex.compile("[a-zÀ-ÖØ-öø-ÿ]+")
_SAMPLE = ["Plain", "words,", "it's", "(x)", "NAÏVE", "Straße", "A1b2", "<|x|>", "d'être", "...end.", "¿qué?", "x,'s", "a\x0b's"]


def _byte_letters() -> dict[int, int]:
    """Byte-level models write printable bytes as themselves, the others as 256 and up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: 256 + n for n, b in enumerate(hidden)}


_SHOWN = _byte_letters()


class PieceEncoder:
    """Ids of many texts at once, equal to `Tokenizer.encode(text, add_special_tokens=False).ids`.

    When the file is read a sample is encoded both ways; for tokenizers of another kind the short cut is
    not taken.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.remembered = remembered
        self._reset()
        self.by_piece = True
        texts = [" \n".join(_SAMPLE) + "\t", *_SAMPLE]
        ids, counts = self.encode(pa.array(texts))
        direct = self.direct(texts)
        self.by_piece = [len(x) for x in direct] == counts.tolist() and [i for x in direct for i in x] == ids.tolist()

    def direct(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, self.width)

    def _fresh(self, pieces: list[str]) -> list[list[int]]:
        """Ids of distinct pieces: letters straight from the model, others by the full path."""
        out, odd, tokenize = [], [], self.model.tokenize
        for at, piece in enumerate(pieces):
            if piece.isascii() and piece.isalpha() and piece.islower():
                out.append([t.id for t in tokenize(piece)])
            elif _LETTERS.fullmatch(piece):
                shown = piece.lower().encode().decode("latin-1").translate(_SHOWN)
                out.append([t.id for t in tokenize(shown)])
            else:
                out.append([])
                odd.append(at)
        for at, ids in zip(odd, self.direct([pieces[at] for at in odd]), strict=True):
            out[at] = ids
        return out

    def _pieces(self, pieces: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces one after the other, number of ids of each piece)."""
        codes = pieces.indices.to_numpy()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False)
        if self.held > self.remembered:
            self._reset()
        get, base = self.known.get, len(self.start)
        at = np.fromiter((get(p, -1) for p in distinct), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        lists = self._fresh(distinct[new].tolist())
        more = np.fromiter(map(len, lists), np.int32, len(lists))
        flat = np.fromiter((i for x in lists for i in x), self.width, int(more.sum()))
        start = np.concatenate([self.start, len(self.ids) + np.cumsum(more, dtype=np.int32) - more])
        length, ids = np.concatenate([self.length, more]), np.concatenate([self.ids, flat])
        at[new] = base + np.arange(len(new))
        # What occurs once here hardly comes again and is not worth the memory.
        often = np.flatnonzero(np.bincount(codes, minlength=len(distinct))[new] > 1)
        if len(often):
            keep = np.repeat(np.isin(np.arange(len(new)), often), more)
            self.known.update(zip(distinct[new[often]].tolist(), range(base, base + len(often)), strict=True))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(more[often], dtype=np.int32) - more[often]])
            self.length, self.ids = np.concatenate([self.length, more[often]]), np.concatenate([self.ids, flat[keep]])
            self.held += len(often) * PIECE_BYTES + sum(map(len, distinct[new[often]])) + int(keep.sum()) * self.ids.itemsize
        index = at[codes]
        counts = length[index]
        begin = start[index] - (np.cumsum(counts, dtype=np.int32) - counts)
        return ids[np.arange(int(counts.sum()), dtype=np.int32) + np.repeat(begin, counts)], counts

    def _split(self, texts: pa.Array, odd: bool) -> tuple[np.ndarray, np.ndarray]:
        if not odd:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _CUT, r" \1 ")
        split = pc.ascii_split_whitespace(texts)
        ids, counts = self._pieces(split.flatten().dictionary_encode())
        end = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        return ids, np.diff(end[split.offsets.to_numpy() - split.offsets[0].as_py()])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, number of ids of each text); null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_piece:
            lists = self.direct(texts.to_pylist())
            return np.array([i for x in lists for i in x], self.width), np.array([len(x) for x in lists], np.int64)
        flags = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        parts = []
        for flag in (False, True):  # filter() also copies: kernels for lower case misread a sliced array
            part, counts[flags == flag] = self._split(texts.filter(pa.array(flags == flag)), flag)
            parts.append(part)
        out, where = np.zeros(int(counts.sum()), self.width), np.repeat(flags, counts)
        out[~where], out[where] = parts
        return out, counts


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of values with about `limit` bytes together; a longer value is a run of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield start, stop
        start = stop


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def documents_ids(
    batches: Iterable[pa.RecordBatch], path: str, text_col: str
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids with the end id after each document, offsets of the documents in them), slice by slice."""
    coder = encoder(path)
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text_col))
        for start, stop in slices(texts):
            ids, counts = coder.encode(texts.slice(start, stop - start))
            offsets = np.concatenate([[0], np.cumsum(counts + 1)])
            out = np.full(offsets[-1], END_ID, ids.dtype)
            hole = np.ones(len(out), bool)
            hole[offsets[1:] - 1] = False
            out[hole] = ids
            yield batch.slice(start, stop - start), out, offsets
