"""Small shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and the pattern of a word.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The maximal runs of characters outside ``SPACE_CLASS``; null and blank texts give an empty array."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE_CLASS))


def hidden(*frames: DataFrame, stem: str) -> str:
    """A column name beginning with ``_<stem>`` that no frame uses (extra columns may clash with ours)."""
    taken = {c.lower() for df in frames for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
