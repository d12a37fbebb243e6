"""Session construction for tests, the bench and local runs.

Library functions never build a session; they take the caller's DataFrames.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tessera", driver_memory: str = "16g") -> SparkSession:
    """A local session tuned like the cluster profile (AQE, skew join, Arrow)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Coalescing targets max(minPartitionSize, min(advisory, total / parallelism)).
        # Itemset and pair enumeration joins emit far more rows than they read, so a
        # few-MB input must not collapse into one task; on large inputs the 64 MB
        # advisory size governs and this floor has no effect.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if os.environ.get("TESSERA_EVENT_LOG_DIR"):
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", os.environ["TESSERA_EVENT_LOG_DIR"]))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Name a checkpoint folder for a one-process session that has none.

    Driver and executors are one process under a ``local[n]`` master, so a
    temporary folder is shared by all of them. On a cluster nothing is set:
    the launcher has to name a shared folder in ``spark.checkpoint.dir``.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None):
        return
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-checkpoints-"))
