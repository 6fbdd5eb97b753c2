"""The queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridcheck.llm import chat_format, language_id, license_scan, line_dedup, mixing, near_dedup, packing, quality_rules, token_counts, topk_search
from gridcheck.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.perspectives(table(spark, sf_dir, "conversations"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ALL = (
    op1_line_dedup,
    op2_chat_format,
    op3_token_counts,
    op4_language_id,
    op5_mixing,
    op6_near_dedup,
    op7_topk_search,
    op8_license_scan,
    op9_packing,
    op10_quality_rules,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.SQL,
        "op2_chat_format": chat_format.SQL,
        "op5_mixing": mixing.SQL,
        "op6_near_dedup": near_dedup.SQL,
        "op7_topk_search": topk_search.SQL,
        "op8_license_scan": license_scan.SQL,
    }
