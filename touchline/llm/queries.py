"""Registered queries of this folder: opN_<name> -> (spark, sf_dir) -> DataFrame.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import (
    decontam, merkle, mixing, pii, prefix_trie, quality, secret_scan, sentencepiece_codec, simhash, substring, suffixarray,
    urlfilter, warc,
)
from touchline.llm.common import read_table, share_package
from touchline.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(read_table(spark, sf_dir, "pages"),
                                 urlfilter.default_rules(spark)).drop("url")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(read_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"),
                                 read_table(spark, sf_dir, "benchmark"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(read_table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.digest(read_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(read_table(spark, sf_dir, "documents"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read_table(spark, sf_dir, "documents"))


def _shared(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return query(spark, sf_dir)
    return run


def llm_queries() -> dict[str, Query]:
    found = (op1_url_filters, op2_secret_scans, op3_sentencepiece, op4_pii, op5_benchmark_decontamination,
             op6_simhash_near_dedup, op7_warc, op8_substring_dedup, op9_suffix_array_dedup, op10_quality_rules,
             op11_prefix_trie, op12_merkle_manifest, op13_source_mix)
    return {q.__name__: _shared(q) for q in found}


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
