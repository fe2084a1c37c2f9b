"""The queries of the corpus operators: thin applications to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import op1_simhash, op2_token_counts, op3_secrets, op4_toxicity, op5_embeddings, op6_decontaminate, op7_mix, op8_warc, op9_language, op10_quality, op11_whitening, op12_language_model, op13_conversations
from panelkit.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_simhash.digest(op1_simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op2_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_token_counts.digest(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_secrets.digest(table(spark, sf_dir, "documents"))


def op4_toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_embeddings.digest(op5_embeddings.near_duplicates(table(spark, sf_dir, "embeddings")))


def op6_decontaminate_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_decontaminate.digest(op6_decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_mix.digest(op7_mix.mix(table(spark, sf_dir, "documents")))


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_warc.digest(op8_warc.round_trip(table(spark, sf_dir, "pages")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_language.digest(table(spark, sf_dir, "documents"))


def op10_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_whitening.digest(table(spark, sf_dir, "embeddings"))


def op12_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_language_model.digest(table(spark, sf_dir, "documents"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_conversations.digest(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_token_lengths": op2_token_lengths,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity_score": op4_toxicity_score,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_decontaminate_benchmark": op6_decontaminate_benchmark,
    "op7_mix_sources": op7_mix_sources,
    "op8_warc_round_trip": op8_warc_round_trip,
    "op9_language_id": op9_language_id,
    "op10_quality_score": op10_quality_score,
    "op11_whiten_embeddings": op11_whiten_embeddings,
    "op12_gru_scores": op12_gru_scores,
    "op13_repair_conversations": op13_repair_conversations,
}

ORACLE: dict[str, str] = {
    "op6_decontaminate_benchmark": op6_decontaminate.ORACLE,
    "op7_mix_sources": op7_mix.ORACLE,
    "op8_warc_round_trip": op8_warc.ORACLE,
}
