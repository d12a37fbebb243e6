"""Readers for the two input shapes of the jobs, plus Parquet tables.

``load_csv`` and ``load_json`` also return what they couldn't read: a line
with the wrong number of columns, broken quotes or broken JSON is a rejected
row with its file and text, beside the good rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.storage import materialize, release

# News-post export: JSON lines with the post text, its id and its url.
TWEETS_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("tweet_id", T.StringType()),
    T.StructField("url", T.StringType()),
])

_BROKEN = "_broken_line"


@dataclass
class Loaded:
    """Rows of text files: those that could be read, and the lines that couldn't."""

    good: DataFrame       # the columns of the file
    rejected: DataFrame   # (file, line)
    n_good: int
    n_rejected: int
    stored: DataFrame

    def release(self) -> None:
        """Delete the parsed table; neither frame may run afterwards."""
        release(self.stored)


def _loaded(parsed: DataFrame, columns: list[str], name: str) -> Loaded:
    # one pass over the files: both outputs come from the same parsed table
    stored = materialize(parsed.select(*columns, _BROKEN, F.input_file_name().alias("_file")), name,
                         {"bad": F.count_if(F.col(_BROKEN).isNotNull())})
    bad = int(stored._tessera_metrics["bad"] or 0)
    good = stored.filter(F.col(_BROKEN).isNull()).select(*columns)
    rejected = stored.filter(F.col(_BROKEN).isNotNull()).select(F.col("_file").alias("file"), F.col(_BROKEN).alias("line"))
    return Loaded(good, rejected, stored._tessera_rows - bad, bad, stored)


def load_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None, multi_line: bool = False) -> Loaded:
    """CSV with a header line (compression by extension); every column is a string, unless ``types`` names one.

    Rejected are lines with more or fewer fields than the header has, and
    with values that are not of the named type. A quoted field may hold
    separators and doubled quotes; with ``multi_line`` also line ends (such a
    file is read by one task), without it a quote that isn't closed on its
    line rejects the line. All files have the header of the first.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    types = types or {}
    schema = T.StructType([T.StructField(c, T._parse_datatype_string(types.get(c, "string"))) for c in header]
                          + [T.StructField(_BROKEN, T.StringType())])
    # all fields of a line are parsed, whatever columns are used later: otherwise short and long lines pass
    parsed = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, enforceSchema=False,
                                columnPruning=False).schema(schema).csv(path)
    return _loaded(parsed, header, "csv")


def load_json(spark: SparkSession, path: str, schema: T.StructType) -> Loaded:
    """JSON lines (compression by extension) under a schema; further fields are not read.

    Rejected are lines that aren't a JSON object and those with a value that
    doesn't fit its type. A missing field is null; blank lines don't count.
    """
    full = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN).schema(full).json(path)
    return _loaded(parsed, schema.names, "json")


def read_conditions_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; compression (gzip, bz2) follows the file extension.

    Columns are matched by header name: their order does not matter, further
    ones are ignored. Only the header line is read for that (nothing is
    inferred: every column is a string); PATIENT, CODE and DESCRIPTION are kept.
    """
    return spark.read.option("header", True).csv(path).select("PATIENT", "CODE", "DESCRIPTION")


def read_documents_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines (compression by extension); the url column is not needed downstream.

    Without a schema, the type of the ids is taken from the data, so numeric
    ids stay numbers and keep their order; ``TWEETS_SCHEMA`` (or any other)
    saves that pass over the input and makes the ids strings.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path).drop("url")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
