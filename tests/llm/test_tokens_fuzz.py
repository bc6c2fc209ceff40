"""The piece encoder against the tokenizer itself, and language profiles against a plain counter."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest

from tidegauge.llm import language, minhash, substring_dedup, tokens


@pytest.fixture(scope="module")
def encoder():
    return tokens.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))


def agree(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts))
    want = encoder.direct([t or "" for t in texts])
    at = 0
    for text, n, one in zip(texts, counts.tolist(), want, strict=True):
        assert ids[at : at + n].tolist() == one, repr(text)
        at += n


def test_ids_equal_the_tokenizer_on_random_texts(encoder):
    rng = random.Random(5)
    bits = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "<", "<|endoftext|>", ".", "..", "1", "23", " ", "\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "the", "É"]
    near = [chr(i) for i in range(0x250)]
    texts = ["".join(rng.choice(bits) if rng.random() < 0.7 else rng.choice(near) for _ in range(rng.randint(1, 9))) for _ in range(100_000)]
    assert encoder.by_piece
    agree(encoder, [*texts, "\x0b's", "\x0b't", None, ""])


def test_small_memory_gives_the_same_ids():
    small = tokens.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"), remembered=2_000)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(3_000)]
    for _ in range(20):
        agree(small, [" ".join(rng.choices(words, k=400)) for _ in range(10)])
    assert small.held < 200_000


def plain_grams(text):
    runs, now = [], ""
    for c in text.lower():
        if c.isalpha() and ord(c) < 1 << 18:
            now += c
        elif now:
            runs.append(now)
            now = ""
    runs += [now] if now else []
    # Between two runs one blank stands, so its bigrams with the letters beside it are counted for each run.
    out = Counter(x for r in runs for x in r)
    for r in runs:
        padded = f" {r} "
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


def name(code):
    kind, body = code >> 60, code & ((1 << 60) - 1)
    return "".join(chr(x) if x else " " for x in [(body >> 18 * k) & 0x3FFFF for k in range(kind, -1, -1)])


@pytest.mark.parametrize("chunk", [5, 64, 1 << 18])
def test_grams_of_whole_texts(chunk, monkeypatch):
    monkeypatch.setattr(language, "CHUNK", chunk)
    rng = random.Random(2)
    for text in ["", "a", "...", " É!", "It's 42 naïve  words", "日本 😀 語", "".join(rng.choices("abé .1\n", k=2_000))]:
        codes, counts = language.grams(text)
        assert Counter({name(c): n for c, n in zip(codes.tolist(), counts.tolist(), strict=True)}) == plain_grams(text)


def plain_ranks(counts, top):
    key = lambda g: (len(g), [0 if c == " " else ord(c) for c in g])
    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:top]


def test_out_of_place_distance_by_hand(spark):
    """The predictions against the published method in plain Python: rank differences, the profile's length where it lacks the n-gram."""
    rng = random.Random(11)
    letters = {"xx": "aaabbcde", "yy": "eeffghia", "zz": "qrstuvwa"}
    rows = [(i, " ".join("".join(rng.choices(letters[k], k=rng.randint(1, 7))) for _ in range(rng.randint(1, 60))), k) for i, k in enumerate(list(letters) * 40)]
    rows += [(900, None, "xx"), (901, "", "xx"), (902, "12 !", "yy"), (903, "ab " * 50_000, None), (None, "ab cd", "xx"), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    import zlib

    held = {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    top, totals = 50, {}
    for i, text, lang in rows:
        if text is not None and lang is not None and not held[i]:
            totals.setdefault(lang, Counter()).update(plain_grams(text))
    ranks = {lang: {g: r for r, g in enumerate(plain_ranks(c, top))} for lang, c in totals.items()}
    want = Counter()
    for i, text, _ in rows:
        mine = plain_ranks(plain_grams(text or ""), top)
        if mine:
            apart = {lang: sum(abs(r.get(g, top + n) - n) for n, g in enumerate(mine)) for lang, r in sorted(ranks.items())}
            best = min(apart, key=apart.get)
            want[i, held[i], best, round(1 - apart[best] / (top * len(mine)), 9)] += 1
        else:
            want[i, held[i], "und", 0.0] += 1
    found = language.identify_languages(docs, top=top).collect()
    assert Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in found) == want


def test_word_places_are_those_of_the_shingles():
    rng = random.Random(3)
    blanks = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u200b", "\ufeff"]
    for _ in range(300):
        text = "".join(rng.choice(blanks) if rng.random() < 0.4 else rng.choice("abÉ日😀.") for _ in range(rng.randint(0, 40)))
        first, last = substring_dedup._word_places(text)
        want = [w for w in pc.utf8_split_whitespace(pa.array([text], pa.large_string()))[0].as_py() if w]
        assert [text[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)] == want


@pytest.mark.parametrize("behind", [b"\x00", b"\xff", b"\x80", b"\t"])
def test_shingles_do_not_depend_on_what_lies_behind_the_texts(behind, monkeypatch):
    lower = minhash.pc.utf8_lower

    def lowered(texts):
        found = lower(texts)
        _, offsets, data = found.buffers()
        own = data.to_pybytes()[: pc.sum(pc.binary_length(found)).as_py()]
        return pa.LargeStringArray.from_buffers(len(found), offsets, pa.py_buffer(own + behind * 8))

    monkeypatch.setattr(minhash.pc, "utf8_lower", lowered)
    for text in ["a b c d E f\n", "a\t", "日 \n\t", "\n", " ", "a" * 63 + "\t", "a b\u3000", "a"]:
        for texts in [[text], ["a b c d e\t", text], [text, None, ""], [text, "É"]]:
            hashes, offsets = minhash.shingles(pa.array(["x y", *texts]).slice(1))
            want = [minhash.shingles(pa.array([" ".join((t or "").lower().split())]))[0].tolist() for t in texts]
            assert [hashes[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == want
    for texts in [pa.array([], pa.string()), pa.array([None], pa.string())]:
        hashes, offsets = minhash.shingles(texts)
        assert len(hashes) == 0 and np.array_equal(offsets, [0] * (len(texts) + 1))
