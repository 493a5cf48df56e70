"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_round_trip
from .common import table
from .exact_dedup import OP1_SQL, exact_dedup
from .licenses import OP2_SQL, license_scan
from .lm_score import lm_score
from .merkle import OP12_SQL, merkle_manifest
from .mixing import OP11_SQL, mixing
from .packing import pack_documents
from .pii import pii_spans
from .quality import OP7_SQL, quality_rules
from .search import OP13_SQL, ranked_search
from .simhash import simhash_dedup
from .suffix_dedup import suffix_dedup
from .url_filter import OP3_SQL, url_filter


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), words=51)


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_simhash": op4_simhash,
    "op5_lm_score": op5_lm_score,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_pii": op8_pii,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_source_mixing": op11_source_mixing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op2_license_scan": OP2_SQL,
    "op3_url_filter": OP3_SQL,
    "op7_quality_rules": OP7_SQL,
    "op11_source_mixing": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
