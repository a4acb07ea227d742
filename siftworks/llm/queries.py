"""The queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftworks.llm import (
    byte_bpe,
    chat_format,
    collocations,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    quality_rules,
    sanitise,
    topk_search,
    warc,
    whitening,
)
from siftworks.llm.frames import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_digest(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digest(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(table(spark, sf_dir, "pages"))


def op5_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.sanitise_digest(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_digest(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup_digest(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.topk_digest(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_digest(table(spark, sf_dir, "embeddings"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digest(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocation_digest(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_line_dedup": op3_line_dedup,
        "op4_warc": op4_warc,
        "op5_sanitise": op5_sanitise,
        "op6_mixing": op6_mixing,
        "op7_language_id": op7_language_id,
        "op8_near_dedup": op8_near_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_topk_search": op10_topk_search,
        "op11_whitening": op11_whitening,
        "op12_chat_format": op12_chat_format,
        "op13_collocations": op13_collocations,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op3_line_dedup": line_dedup.ORACLE,
        "op6_mixing": mixing.ORACLE,
        "op10_topk_search": topk_search.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
