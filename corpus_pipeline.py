"""The corpus pipeline: stages over ``documents``, each written and reread.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents``; the last returns the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sysledger.llm import bpe_prefix, exact_dedup, ordinal_quality, parity_join, temperature_mix
from sysledger.llm.common import scratch, table
from sysledger.llm.queries import WORD_BPE


def rated_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tail probability for the top grade is too low go."""
    ratings = ordinal_quality.graded(table(spark, sf_dir, "labels"))
    return ordinal_quality.select_rows(docs, ordinal_quality.fit(docs, ratings))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (Jaccard of 0.8 or
    more over shingles of five words)."""
    return parity_join.drop_near_copies(docs, percent=80, width=5)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources as even as two passes allow; every document at least once."""
    return temperature_mix.repeat_rows(docs, max_repeats=2.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, encoded and decoded."""
    return bpe_prefix.round_trip(docs, WORD_BPE)


STAGES = [
    ("quality classifier", rated_quality),
    ("exact dedup", exact_copies),
    ("n-gram jaccard join", near_copies),
    ("source mix", source_mix),
    ("bpe", token_ids),
]

# No SQL states the fitted classifier or the encoder; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
