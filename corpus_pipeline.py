"""From raw documents to packed training sequences, in five stages that each work on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthwatt.llm import decontamination, language, neardup, packing, secrets
from hearthwatt.llm.frames import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without letters or without a likely language go."""
    return language.identified(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, a similarity of 0.8)."""
    return neardup.distinct_documents(docs)


def unseen_by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mask."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences that they fill."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("minhash_near_dedup", one_of_each),
    ("benchmark_decontamination", unseen_by_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: No stage but the third could be told in SQL (a learned model, a subword vocabulary); see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
