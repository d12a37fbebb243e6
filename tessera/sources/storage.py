"""Lineage cuts that survive executor loss.

Intermediate results are written as Parquet below the shared folder the
cluster names in ``spark.checkpoint.dir`` and read back, so a lost executor
only costs the recomputation of its own shuffle blocks, never the whole
lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, which the launcher has to name."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) that every executor can read")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the checkpoint folder that nothing uses yet."""
    return f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", metrics: dict | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the checkpoint folder and return the re-read table.

    The re-read plan is a plain file scan: it has file-size statistics for the
    planner, prunes columns and pushes filters, and its lineage is cut. Its
    exact row count is observed during the write itself (``DataFrame.observe``)
    and recorded, so later broadcast decisions need no extra job; further
    aggregate ``metrics`` (name -> column) are observed in the same pass and
    kept in ``_tessera_metrics``.
    """
    if "rows" in (metrics or {}):
        raise ValueError("the metric 'rows' is the row count")
    spark = df.sparkSession
    path = new_folder(spark, name)
    rows = Observation(f"rows_{name}")
    extra = [col.alias(key) for key, col in (metrics or {}).items()]
    df.observe(rows, F.count(F.lit(1)).alias("rows"), *extra).write.mode("errorifexists").parquet(path)
    out = spark.read.parquet(path)
    observed = rows.get
    out._tessera_rows = int(observed["rows"])
    out._tessera_metrics = {key: observed[key] for key in (metrics or {})}
    return out


def row_count(df: DataFrame) -> int:
    """Exact row count: recorded by :func:`materialize`, else counted now."""
    known = getattr(df, "_tessera_rows", None)
    return known if known is not None else df.count()


def release(*tables: DataFrame) -> None:
    """Delete the folders of tables returned by :func:`materialize` (shared file system).

    Call it once no DataFrame derived from them will run again.
    """
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
