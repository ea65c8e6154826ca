"""The ``opN_*`` queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fuzzyhash, htmltext, jaccard, langid, mixing, packing, quality, secret_scan, sharding, substrings
from .common import read_table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digests(read_table(spark, sf_dir, "documents"))


def op3_fuzzy_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzyhash.fingerprint_digest(read_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.page_digest(read_table(spark, sf_dir, "pages"))


def op5_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(read_table(spark, sf_dir, "documents"))


def op6_suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digest(read_table(spark, sf_dir, "documents"))


def op7_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read_table(spark, sf_dir, "documents"))


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read_table(spark, sf_dir, "documents"))


def op9_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), keep_ids=False)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_fuzzy_fingerprints": op3_fuzzy_fingerprints,
    "op4_html_extraction": op4_html_extraction,
    "op5_compression_langid": op5_compression_langid,
    "op6_suffix_automaton_dedup": op6_suffix_automaton_dedup,
    "op7_hash_tree_shards": op7_hash_tree_shards,
    "op8_pfair_mix": op8_pfair_mix,
    "op9_power_of_two_packing": op9_power_of_two_packing,
    "op10_jaccard_join": op10_jaccard_join,
}

ORACLES: dict[str, str] = {
    "op6_suffix_automaton_dedup": substrings.ORACLE_SQL,
    "op7_hash_tree_shards": sharding.ORACLE_SQL,
    "op8_pfair_mix": mixing.ORACLE_SQL,
    "op10_jaccard_join": jaccard.ORACLE_SQL,
}
