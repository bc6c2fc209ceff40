"""Odd inputs of operators that other files do not cover: very long texts, repeated rows and null ids."""

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import mixing, quality, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, score double"


@pytest.fixture(scope="module")
def long_docs(spark):
    passage = " ".join(f"w{i % 97}x{i}" for i in range(70))
    rows = [(i, f"{'good' if i % 2 else 'bad'} text number {i} " * 10, "en", "s", 0.1) for i in range(60)]
    rows += [(100, "good " * 300_000, "en", None, None), (101, f"before {passage} after", "en", "s", None), (102, f"other {passage} end", None, "s", None)]
    rows += [(102, f"other {passage} end", None, "s", None), (None, f"third {passage} here", "en", "s", None), (103, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA), passage


def test_quality_of_very_long_texts(spark, long_docs):
    docs, _ = long_docs
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    found = quality.score_quality(docs, labels, rounds=1).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert len({(r.score, r.keep) for r in found if r.doc_id == 102}) == 1


def test_mixing_of_very_long_texts(spark, long_docs):
    docs, _ = long_docs
    domains = spark.createDataFrame([(i, "good" if i % 2 else "bad") for i in range(60)], "doc_id long, domain string")
    found = mixing.document_rates(docs, domains, {"good": 1.0, "bad": 1.0}).collect()
    assert len(found) == docs.count() and max(r.tokens for r in found) == 300_000 and all(r.rate >= 0 for r in found)
    assert len({r.rate for r in found if r.doc_id == 102}) == 1


def test_runs_of_repeated_rows_and_null_ids(spark, long_docs):
    docs, passage = long_docs
    broken = docs.withColumn("text", F.regexp_replace("text", "((?:\\S+ ){9}\\S+) ", "$1\n"))  # no line is long enough for a paragraph
    for table in (docs, broken):
        found = [r for r in substring_dedup.repeated_passages(table, runs=True).collect() if r.words >= 60 and r.doc_id in (None, 101, 102)]
        # The row without an id comes first and stays; the others go, each row of a repeated one by itself.
        assert {(r.doc_id, r.kept) for r in found} == {(None, True), (101, False), (102, False)}
        assert sum(r.doc_id == 102 for r in found) == 2
