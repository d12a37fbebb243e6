"""The operators bound to the tables: ``opN_<name>`` queries with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    curve_search, embedding_dedup, lexical_search, main_text, mixing, near_dedup, packing, prefix_trie, private_data, quality,
    sharding, token_store, toxicity,
)
from .common import read_table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.op1(read_table(spark, sf_dir, "documents"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.op2(read_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op3(read_table(spark, sf_dir, "documents"))


def op4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.op4(read_table(spark, sf_dir, "pages"))


def op5_prefix_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op5(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op6(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.op7(read_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op8(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.op9(read_table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op10(read_table(spark, sf_dir, "documents"))


def op11_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.op11(read_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.op12(read_table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.op13(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}
