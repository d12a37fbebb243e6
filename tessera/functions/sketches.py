"""Fixed-size sketches of a column: count-min tables and Bloom filters.

Every task fills a table of its own; the tables are cut into parts, summed
(or or-ed) part by part on the executors, and one table, whose size is a
parameter, reaches the driver and the kernels that use it. A larger input
makes a sketch less sharp, never larger.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # kernels are shipped by value, as in functions.hashing
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

PART = 1 << 16        # cells of a part of a table
WIDTH = 1 << 20       # cells of a row of a count-min table
BLOOM_BITS = 1 << 26  # bits of a Bloom filter (8 MB)
BLOOM_TASKS = 32      # tasks that fill a Bloom filter
# odd multipliers of the multiply-shift hashes, one per row or probe
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def places(values: np.ndarray, lane: int, cells: int) -> np.ndarray:
    """Cells (a power of two many) of 64-bit values."""
    bits = cells.bit_length() - 1
    mixed = values.astype(np.uint64) * np.uint64(MULTIPLIERS[lane])
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(MULTIPLIERS[(lane + 1) % 3])) >> np.uint64(64 - bits)).astype(np.int64)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, for kernels that make much of a row."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _filled(add: Callable, cells: int, dtype: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in slices(batches):
            table = np.zeros(cells, dtype) if table is None else table
            add(table, batch)
        for part, start in enumerate(range(0, cells if table is not None else 0, PART)):
            if not table[start:start + PART].any():
                continue
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([table[start:start + PART].tobytes()], pa.binary())],
                                             names=["part", "cells"])
    return run


def _merged(merge: np.ufunc, dtype: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        row = lambda: pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["part", "cells"])
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(cells.as_buffer(), dtype)
                if part == now:
                    merge(held, values, out=held)
                    continue
                if held is not None:
                    yield row()
                now, held = part, values.copy()
        if held is not None:
            yield row()
    return run


def merged_table(frame: DataFrame, add: Callable, cells: int, dtype: str, merge: np.ufunc) -> np.ndarray:
    """The table that ``add(table, record_batch)`` fills over all rows of a frame."""
    out = np.zeros(cells, dtype)
    rows = (frame.mapInArrow(_filled(add, cells, dtype), "part int, cells binary").repartition("part").sortWithinPartitions("part")
            .mapInArrow(_merged(merge, dtype), "part int, cells binary").collect())  # ``cells`` cells in all
    for row in rows:
        out[row["part"] * PART:][:PART] = np.frombuffer(row["cells"], dtype)
    return out


class CountMin:
    """Counts of 64-bit tokens, never below the true ones: the least of two cells."""

    def __init__(self, table: np.ndarray, width: int):
        self.rows = np.minimum(table, np.iinfo(np.uint32).max).astype(np.uint32).reshape(2, width)
        self.width = width

    @classmethod
    def of(cls, sets: DataFrame, column: str, width: int = WIDTH) -> CountMin:
        """Over all elements of an array column."""
        return cls.over(sets.select(column), lambda batch: batch.column(0).flatten().to_numpy(zero_copy_only=False), width)

    @classmethod
    def over(cls, frame: DataFrame, tokens: Callable[[pa.RecordBatch], np.ndarray], width: int = WIDTH) -> CountMin:
        """Over the tokens that a kernel takes from every batch of a frame."""
        def add(table: np.ndarray, batch: pa.RecordBatch) -> None:
            found = tokens(batch)
            for lane in (0, 1):
                np.add.at(table[lane * width:(lane + 1) * width], places(found, lane, width), 1)
        return cls(merged_table(frame, add, 2 * width, "<i8", np.add), width)

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        return np.minimum(*[self.rows[lane][places(tokens, lane, self.width)] for lane in (0, 1)]).astype(np.int64)


class Bloom:
    """Membership of values by three bits of their ``xxhash64``: no false negatives."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    @classmethod
    def of(cls, values: DataFrame, column: str, bits: int = BLOOM_BITS) -> Bloom:
        def add(table: np.ndarray, batch: pa.RecordBatch) -> None:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            for lane in range(3):
                at = places(h, lane, bits)
                np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
        # a value costs a few bytes and three bits: few tasks, so that few tables are merged
        hashes = values.select(F.xxhash64(column).alias("h")).coalesce(BLOOM_TASKS)
        return cls(merged_table(hashes, add, bits // 8, "<u1", np.bitwise_or), bits)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for lane in range(3):
            at = places(hashes, lane, self.bits)
            out &= (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def may_hold(self, column: str | Column) -> Column:
        """Condition that is true for every value of the filter, and for few others.

        A kernel that follows on the same rows had better call :meth:`holds`
        on their ``xxhash64`` itself: two Python steps are two workers a task.
        """
        @F.arrow_udf(T.BooleanType())
        def _holds(h: pa.Array) -> pa.Array:
            return pa.array(self.holds(h.to_numpy(zero_copy_only=False)))
        return _holds(F.xxhash64(column))
