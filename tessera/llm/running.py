"""Running sums inside keys, for tables in which one key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.storage import materialize, release


def _local(n_key: int, values: list[str]):
    """Sums over the rows of a key that lie in this task, in the order given."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last_key, carry = None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_key)], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            goes_on = last_key is not None and np.array_equal(key[0], last_key)
            sums = []
            for k, name in enumerate(values):
                total = np.cumsum(batch.column(name).to_numpy(zero_copy_only=False))
                before = np.where(starts > 0, total[starts - 1], 0)
                if goes_on:
                    before[0] -= carry[k]
                sums.append(total - before[run_of])
            last_key, carry = key[-1], [s[-1] for s in sums]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(s, pa.int64()) for s in sums], pa.array(np.full(n, task, np.int32))],
                names=[*batch.schema.names, *[f"{v}_sum" for v in values], "task"])
    return run


def running_sums(df: DataFrame, key: list[str], order: list[str], values: list[str], name: str) -> DataFrame:
    """``df`` plus ``<v>_sum`` per value: the sum over the rows of the key up to and with this one, stored.

    Rows are range-partitioned by key and order, so the rows of a large key
    lie in several tasks; each task sums its own, and only keys that reach
    over tasks get an offset, from one total per key and task. All columns of
    ``key`` and ``values`` are longs without nulls.
    """
    df = df.select(*key, *[c for c in df.columns if c not in key])
    schema = T.StructType([*df.schema.fields, *[T.StructField(f"{v}_sum", T.LongType()) for v in values],
                           T.StructField("task", T.IntegerType())])
    local = materialize(df.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)
                        .mapInArrow(_local(len(key), values), schema), f"{name}-local")
    per_task = local.groupBy(*key, "task").agg(*[F.sum(v).alias(v) for v in values])
    spread = per_task.groupBy(*key).agg(F.count(F.lit(1)).alias("_tasks")).filter("_tasks > 1").select(*key)
    before = Window.partitionBy(*key).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_task.join(spread, key, "left_semi")
               .select(*key, "task", *[F.sum(v).over(before).alias(f"{v}_before") for v in values]))
    offsets = materialize(offsets, f"{name}-offsets")
    out = local.join(offsets, [*key, "task"], "left") if offsets._tessera_rows else local
    plus = lambda v: F.coalesce(F.col(f"{v}_before"), F.lit(0)) if offsets._tessera_rows else F.lit(0)
    out = materialize(out.select(*df.columns, *[(F.col(f"{v}_sum") + plus(v)).alias(f"{v}_sum") for v in values]), name)
    release(local, offsets)
    return out
