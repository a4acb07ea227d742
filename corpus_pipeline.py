"""From raw documents to token ids: the stages of a training corpus, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftworks.llm import byte_bpe, line_dedup, mixing, near_dedup, quality_rules
from siftworks.llm.frames import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many documents share."""
    return line_dedup.without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies."""
    return near_dedup.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return byte_bpe.encoded_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("byte_bpe", tokens),
]

# Learned rules, sketches and byte-pair merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
