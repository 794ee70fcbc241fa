"""A training corpus from the documents, in five stages.

Each stage works on all that the one before kept, and but for the last returns the
columns of documents. SQL cannot express the stages, so ORACLE_SQL is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from disclosure_spark.llm import forest, mixing, pieces, quality, surrogates
from disclosure_spark.llm.shared import discard, drop_shuffles, read_table, saved

ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return forest.survivors(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data and secrets."""
    return surrogates.replace(docs).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources has them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    return pieces.with_ids(docs, pieces.load())


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", different),
    ("PII", private),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written, read again, and deleted when the next one is there."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, saved(stage(spark, docs, sf_dir), f"stage_{i}")
        if i:
            discard(before)
        drop_shuffles(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
