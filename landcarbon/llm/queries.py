"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landcarbon.llm import byte_bpe, conversation_repair, curriculum, decontaminate, kneser_ney, license_scan, order_minhash, pii, quality_rules, secret_scan, spelling, token_store, weak_quality
from landcarbon.llm.common import read

END_ID = 2


def vocabulary(name: str) -> bytes:
    """A vocabulary file of a public tokenizer; under 4 MB, so it travels with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(read(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality(read(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.classes(read(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.licenses(read(spark, folder, "documents")).drop("detections")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    blocks = decontaminate.automata(read(spark, folder, "benchmark"))
    return decontaminate.report(decontaminate.matches(read(spark, folder, "documents"), blocks))


def op6_weak_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    judged = weak_quality.scored(docs, weak_quality.train(docs))
    return judged.selectExpr("doc_id", *(f"p_{a}" for a in weak_quality.ASPECTS), "rejected", "not rejected as kept")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return pii.report(pii.personal_data(docs, pii.train(docs)))


def op8_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return kneser_ney.scores(docs, kneser_ney.train(docs))


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(read(spark, folder, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), pattern())


def op10_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.stored(read(spark, folder, "documents"), vocabulary("word_bpe_49k.json").decode(), END_ID)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    talks = read(spark, folder, "conversations")
    return conversation_repair.report(talks, conversation_repair.damaged(talks))


def op12_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    return curriculum.report(read(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_quality_rules,
        op3_order_minhash,
        op4_license_scan,
        op5_decontaminate,
        op6_weak_quality,
        op7_pii,
        op8_kneser_ney,
        op9_byte_bpe,
        op10_token_store,
        op11_conversation_repair,
        op12_curriculum,
        op13_spelling_variants,
    )
}
