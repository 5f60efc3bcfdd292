"""The corpus operators as registered queries ``(spark, sf_dir) -> DataFrame``
over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_prefix,
    equal_average,
    exact_dedup,
    filter_audit,
    hash_tree,
    license_scan,
    line_dedup,
    ordinal_quality,
    parity_join,
    risk_rules,
    temperature_mix,
    token_scan,
    warc_derive,
)
from .common import table
from .oracle_sql import ORACLE  # noqa: F401  the queries that SQL can state

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_separator_scan(spark: SparkSession, sf: str) -> DataFrame:
    return token_scan.token_counts(table(spark, sf, "documents"), BYTE_BPE, public_tokenizers.PATTERN, separator=50256)


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(license_scan.with_paths(table(spark, sf, "documents")))


def op3_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    return warc_derive.derivatives(warc_derive.response_records(table(spark, sf, "pages")))


def op4_ordinal_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return ordinal_quality.score(docs, ordinal_quality.fit(docs, ordinal_quality.graded(table(spark, sf, "labels"))))


def op5_hash_tree(spark: SparkSession, sf: str) -> DataFrame:
    return hash_tree.shard_documents(table(spark, sf, "documents"), hash_tree.layout(5, 2, 4))


def op6_risk_rules(spark: SparkSession, sf: str) -> DataFrame:
    return risk_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_parity_join(spark: SparkSession, sf: str) -> DataFrame:
    return parity_join.jaccard_components(table(spark, sf, "documents"), percent=90, width=3)


def op8_temperature_mix(spark: SparkSession, sf: str) -> DataFrame:
    return temperature_mix.mix(table(spark, sf, "documents"), max_repeats=2.0)


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


def op10_bpe_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_prefix.round_trip(table(spark, sf, "documents"), WORD_BPE)


def op11_equal_average(spark: SparkSession, sf: str) -> DataFrame:
    found = equal_average.product_codes(table(spark, sf, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf, "documents"), min_chars=40, min_docs=5)


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_separator_scan, op2_license_scan, op3_warc_derivatives, op4_ordinal_quality, op5_hash_tree, op6_risk_rules,
    op7_parity_join, op8_temperature_mix, op9_exact_dedup, op10_bpe_prefix, op11_equal_average, op12_line_dedup, op13_filter_audit)}
