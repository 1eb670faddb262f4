"""Corpus pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landcarbon.llm import byte_bpe, decontaminate, order_minhash, secret_scan, weak_quality
from landcarbon.llm.common import read, staged
from landcarbon.llm.queries import pattern, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier does not reject."""
    return weak_quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return order_minhash.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that consist mostly of them go."""
    return decontaminate.cleaned(docs, decontaminate.automata(read(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secret_scan.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as counts and digests, checked by decoding."""
    return byte_bpe.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), pattern())


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("secret scan", secrets),
    ("byte-level BPE", encode),
]

# No SQL expresses a trained classifier, near-duplicate classes by sketches, or byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
