"""Sinks: Parquet tables, rule text lines and tab-separated top lists.

Everything is written by the executors; nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.storage import materialize


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  compression: str = "gzip") -> None:
    df.write.mode(mode).parquet(path, compression=compression)


def write_rule_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One text line per rule (the ``line`` column of ``rule_lines``), in the order of the frame over the part files."""
    lines.select("line").write.mode(mode).text(path)


def write_top_itemsets_tsv(top: DataFrame, path: str, label: str, mode: str = "overwrite") -> None:
    """Tab-separated ``<label>\\tcount`` report of a labelled top list.

    The itemset is printed as a list of descriptions, e.g. ``['a', 'b']``.
    The input is a top-n result (bounded by n rows), so it is written as a
    single ordered file.
    """
    descs = sorted(c for c in top.columns if c.startswith("description"))
    # an item without a description stands for itself
    named = [F.coalesce(F.col(c), F.col(c.replace("description", "item")).cast("string")) for c in descs]
    listing = F.concat(F.lit("['"), F.concat_ws("', '", *named), F.lit("']"))
    (top.orderBy("rank").select(listing.alias(label), F.col("support").alias("count"))
     .coalesce(1).write.mode(mode).option("sep", "\t").option("header", True).csv(path))


MANIFEST = "_manifest"


def write_ordered(df: DataFrame, order: list, path: str, kind: str = "text", options: dict | None = None) -> DataFrame:
    """Write ``df`` in one global order over many files, with a manifest; returns the manifest.

    The rows are range-partitioned by ``order`` (columns or sort expressions)
    and sorted in their tasks, so the files in the order of their names hold
    the order. The manifest, a row per file ``(part, first_rank, rows)`` in
    ``<path>/_manifest``, is written last: a folder without one is not
    finished. ``kind`` is ``text`` (one string column), ``csv``, ``json`` or
    ``parquet``; ``options`` go to the writer.
    """
    spark = df.sparkSession
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("errorifexists").options(**(options or {})).format(kind).save(path))
    sizes = (_read_back(spark, path, kind, df.schema, options).groupBy(F.input_file_name().alias("file"))
             .agg(F.count(F.lit(1)).alias("rows")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    manifest = sizes.select(F.element_at(F.split("file", "/"), -1).alias("part"), "rows")
    manifest = manifest.select("part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) + 1).alias("first_rank"), "rows")
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{path}/{MANIFEST}")
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_ordered(spark: SparkSession, path: str, kind: str, schema: T.StructType, options: dict | None = None) -> DataFrame:
    """The rows that :func:`write_ordered` wrote, with their ``rank`` in the order of the manifest.

    A file may be read by several tasks: its pieces are numbered by where
    they begin, from counts per piece, so no file is gathered in one task.
    """
    rows = _read_back(spark, path, kind, schema, options).select(
        "*", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("_part"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    rows = materialize(rows, "ordered")
    pieces = rows.groupBy("_part", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_part").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_part", "_block", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    manifest = spark.read.parquet(f"{path}/{MANIFEST}").select(F.col("part").alias("_part"), "first_rank")
    # ids inside a piece are consecutive: they count the rows of one task
    return (rows.join(pieces, ["_part", "_block"]).join(manifest, "_part")
            .select((F.col("first_rank") + F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), *schema.names))


def _read_back(spark: SparkSession, path: str, kind: str, schema: T.StructType, options: dict | None) -> DataFrame:
    return spark.read.schema(schema).options(**(options or {})).format(kind).load(path)
