"""Every stage of the corpus pipeline against brute force, over the smallest tables and some odd rows."""

import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tidegauge.llm.frames import written
from tidegauge.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "x", 0), (10_003, "12 34 !!", None, "x", 8), (None, "these are words without an id", None, None, 9)], docs.schema)
    now = docs.union(odd)
    out = [now]
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, SF), name)
        out.append(now)
    return docs.columns, [[tuple(r) for r in df.collect()] for df in out], [df.columns for df in out]


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in entry.queries()


def test_columns_stay(stages):
    columns, _, found = stages
    assert all(c == columns for c in found[:-1])


def test_language_keeps_what_has_letters(stages):
    _, rows, _ = stages
    assert Counter(rows[1]) == Counter(r for r in rows[0] if any(c.isalpha() for c in r[1] or ""))


def test_one_of_equal_texts_stays(stages):
    _, rows, _ = stages
    best = {}
    for r in rows[1]:
        key = "".join(c.lower() if c.isascii() else c for c in r[1])
        if key not in best or (r[0] is not None and (best[key][0] is None or r[0] > best[key][0])):
            best[key] = r
    assert Counter(rows[2]) == Counter(best.values())


def test_one_of_each_near_group_stays(stages):
    _, rows, _ = stages
    sets = [shingle_set(r[1]) for r in rows[2]]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    groups = defaultdict(list)
    for i, r in enumerate(rows[2]):
        groups[root(i)].append(r)
    want = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
    assert Counter(rows[3]) == Counter(want)


def test_mixing_repeats_or_drops_whole_documents(stages):
    _, rows, _ = stages
    before, after = set(rows[3]), Counter(rows[4])
    assert set(after) <= before and len(after) > 0.6 * len(before)


def test_packing_holds_all_tokens(stages):
    _, rows, columns = stages
    tokenizer, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in rows[4]:
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 1]
        for a in range(0, len(ids), 4096):
            part = ids[a : a + 4096]
            want[r[0], a // 4096, a, len(part), zlib.crc32(np.array(part, "<u4"))] += 1
    assert Counter(r[:5] for r in rows[5]) == want
    places = defaultdict(list)
    for r in rows[5]:
        row = dict(zip(columns[5], r, strict=True))
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= -(-sum(k[3] * n for k, n in want.items()) // 4096) + 1


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
