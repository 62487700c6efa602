"""Registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from icuflow.llm import (chat, decontaminate, filter_audit, langid, minhash_dedup, oracles, pivot_search, quality_model, quality_rules,
                         sentencepiece_codec, substring_dedup, suffix_dedup, urls, vector_codes)
from icuflow.sources.tables import table as load


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(load(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(load(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(load(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(load(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(load(spark, sf_dir, "conversations"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.digest(load(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(load(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(load(spark, sf_dir, "documents"))


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.digest(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(load(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(load(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (op1_minhash_dedup, op2_sentencepiece, op3_suffix_dedup, op4_decontaminate, op5_quality_rules, op6_chat_format, op7_url_filter, op8_substring_dedup, op9_language_id, op10_quality_model,
          op11_pivot_search, op12_filter_audit, op13_vector_codes)
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_dedup": oracles.OP1, "op3_suffix_dedup": oracles.OP3, "op4_decontaminate": oracles.OP4,
            "op6_chat_format": chat.SQL, "op8_substring_dedup": oracles.OP8,
            "op11_pivot_search": oracles.OP11, "op12_filter_audit": oracles.OP12, "op13_vector_codes": oracles.OP13}
