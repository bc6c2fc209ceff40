"""Training-data pipeline over `documents`: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import exact_dedup, language, mixing, ngram_join, packing
from tidegauge.llm.frames import table, written
from tidegauge.llm.queries import BUDGET, TARGETS, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without text or without a letter go."""
    return language.keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for the case of A-Z."""
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of word shingles of 0.8 or more."""
    return ngram_join.without_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates say that bring good, poor and toxic tokens to their target weights."""
    domains = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mixed_documents(docs, domains, TARGETS, budget=BUDGET)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: Profiles, classifier and tokenizer have no SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
