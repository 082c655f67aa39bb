"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mailsift.llm import (
    chat, divergence, embedding_dedup, html_extract, importance, language_id, mixing, ngram_join, packing, pii, substring_dedup, token_counts,
    topk_search,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.result(_table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.result(_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.result(_table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.result(_table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.result(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.result(_table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.result(_table(spark, sf_dir, "conversations"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.result(_table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.result(_table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.result(_table(spark, sf_dir, "documents"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.result(_table(spark, sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.result(_table(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.result(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_mix_sources, op3_ngram_join, op4_topk_search, op5_best_fit_packing, op6_substring_dedup, op7_chat_formatting,
        op8_language_id, op9_embedding_dedup, op10_pii, op11_divergence_audit, op12_html_extraction, op13_importance_resampling,
    )
}
ORACLES: dict[str, str] = {
    "op2_mix_sources": mixing.ORACLE, "op4_topk_search": topk_search.ORACLE, "op7_chat_formatting": chat.ORACLE,
    "op11_divergence_audit": divergence.ORACLE, "op13_importance_resampling": importance.ORACLE,
}
