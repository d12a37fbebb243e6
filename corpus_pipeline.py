"""Corpus pipeline: documents through a row of stages, each one operator of ``tessera.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All stages
but the last return the columns of ``documents``; the last returns the packed
pieces with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, near_dedup, packing, private_data, quality
from tessera.llm.common import read_table
from tessera.sources.storage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return near_dedup.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks."""
    return private_data.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 1024: a row per piece."""
    return packing.piece_rows(packing.pack_documents(docs))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("source_mixing", source_mixing), ("packing", packed)]

# Not expressible in SQL; tests/llm/test_pipeline.py holds it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
