"""A corpus pipeline over ``documents``: quality, exact and near duplicates, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from normwatch.llm.bpe import encode
from normwatch.llm.common import stored, table
from normwatch.llm.exact_dedup import drop_duplicates
from normwatch.llm.mixing import mixed_documents
from normwatch.llm.quality import accepted
from normwatch.llm.simhash import drop_near_duplicates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be good."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at least once and none more than twice, by tempered shares."""
    return mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the whole text, and the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

# Statistics, fingerprints and merges have no counterpart in SQL; tests/llm compares by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written and read again as the documents of the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
