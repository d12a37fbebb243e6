"""Two other ways to count an itemset level, for vocabularies and baskets that the joins are dear for.

*Wide vocabularies* (many items of small support): most pairs occur a few
times and are shuffled only to be dropped. Pairs are hashed into a table of
fixed size and counted there first (a task hands on its cells, not its pairs);
a pair whose cell has less than the support can't have it, so only pairs of
rich cells are counted one by one.

*Dense baskets* (most items in most baskets): the pairs and triples of the
baskets outnumber the baskets' rows by far. Every item gets a bitmap over the
baskets, and the support of a candidate is the number of bits in the
intersection of its items' bitmaps. Baskets are dealt into blocks; only basket
rows and, per task, one count per candidate are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.itemsets import basket_pairs
from tessera.sources.storage import materialize

try:  # kernels are shipped by value, as in functions.hashing
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

PAIR_CELLS = 1 << 20           # cells of the table of pair hashes (its rich cells are broadcast: 8 MB at most)
BLOCK_ROWS = 1 << 19           # basket rows of a block of bitmaps, on average (some 60 MB of a worker while it is filled)
MAX_CANDIDATES = 2_000_000     # candidates shipped to the bitmaps' kernel (24 MB)
DENSITY = 1 / 16               # share of (basket, item) cells that are set from which bitmaps are taken
_STEP = 1 << 22                # words intersected at once


# ------------------------------------------------------------------ wide vocabularies

def pair_cell(cells: int) -> Column:
    return F.pmod(F.xxhash64("item_1", "item_2"), F.lit(cells)).cast("int")


def is_wide(n_items: int, cells: int = PAIR_CELLS) -> bool:
    """Whether the possible pairs outnumber the cells, so that a task's cells are fewer than its pairs may be."""
    return n_items * (n_items - 1) // 2 > 2 * cells


def rich_cells(pairs: DataFrame, threshold: int, cells: int = PAIR_CELLS) -> DataFrame:
    """``(cell)`` of the cells whose pairs reach the threshold together, stored."""
    counted = pairs.groupBy(pair_cell(cells).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.filter(F.col("n") >= threshold).select("cell"), "rich_cells")


def pruned_pairs(pruned: DataFrame, threshold: int, max_items: int | None = None, cells: int = PAIR_CELLS) -> DataFrame:
    """``(item_1, item_2)`` of every basket, less the pairs in poor cells: what is left to be shuffled and counted."""
    pairs = basket_pairs(pruned, max_items)
    rich = rich_cells(pairs, threshold, cells)
    return (pairs.withColumn("cell", pair_cell(cells))
            .join(F.broadcast(rich), "cell", "left_semi").select("item_1", "item_2"))


def frequent_pairs_by_cells(pruned: DataFrame, threshold: int, max_items: int | None = None,
                            cells: int = PAIR_CELLS) -> DataFrame:
    """``(item_1, item_2, support)`` with at least ``threshold`` baskets; same rows as the plain count."""
    counts = pruned_pairs(pruned, threshold, max_items, cells).groupBy("item_1", "item_2").agg(F.count(F.lit(1)).alias("support"))
    return counts.filter(F.col("support") >= threshold)


# ------------------------------------------------------------------ dense baskets

def is_dense(n_rows: int, n_baskets: int, n_items: int) -> bool:
    return n_baskets > 0 and n_items > 0 and n_rows >= DENSITY * n_baskets * n_items


def _bitmaps(baskets: np.ndarray, items: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """``(items of the vocabulary) x (words)``: a bit per basket of the block."""
    _, number = np.unique(baskets, return_inverse=True)
    words = -(-(int(number.max()) + 1) // 64)
    out = np.zeros((len(vocabulary), words), np.uint64)
    row = np.searchsorted(vocabulary, items)
    np.bitwise_or.at(out, (row, number >> 6), np.uint64(1) << (number & 63).astype(np.uint64))
    return out


def _supports(bits: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Baskets that hold all items of each candidate (rows of places in the vocabulary)."""
    out = np.empty(len(candidates), np.int64)
    step = max(1, _STEP // bits.shape[1])
    for at in range(0, len(candidates), step):
        some = candidates[at:at + step]
        both = bits[some[:, 0]]
        for k in range(1, some.shape[1]):
            both &= bits[some[:, k]]
        out[at:at + step] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return out


def _counted(vocabulary: np.ndarray, candidates: np.ndarray):
    """Per task, every candidate's baskets over the blocks that the task reads, block by block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates), np.int64)
        now, held = None, []

        def settle() -> None:
            if held:
                baskets, items = (np.concatenate([h[k] for h in held]) for k in (0, 1))
                np.add(total, _supports(_bitmaps(baskets, items, vocabulary), candidates), out=total)
                held.clear()
        for batch in batches:
            block, basket, item = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else []
            for start, end in zip(cuts, [*cuts[1:], len(block)], strict=True):
                if block[start] != now:
                    settle()
                    now = block[start]
                held.append((basket[start:end], item[start:end]))
        settle()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["candidate", "support"])
    return run


def count_by_bitmaps(pruned: DataFrame, candidates: DataFrame, n_rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``candidates`` (``item_1, item_2, ...`` of long item codes, stored) with their ``support`` over ``(basket, item)`` rows.

    ``pruned`` has each row once. Baskets are dealt into blocks of about
    ``block_rows`` rows by their hash. A basket has at most as many rows as
    there are codes. Candidates that no basket holds are left out.
    """
    columns = [c for c in candidates.columns if c.startswith("item_")]
    rows = candidates.select(*columns).toArrow()  # MAX_CANDIDATES at most, see mine_itemsets
    codes = np.stack([rows.column(c).to_numpy() for c in columns], axis=1) if rows.num_rows else np.zeros((0, len(columns)), np.int64)
    vocabulary = np.unique(codes)
    blocks = max(1, -(-n_rows // block_rows))
    hashed = pruned.select(F.pmod(F.xxhash64("basket"), F.lit(blocks)).cast("int").alias("block"),
                           F.xxhash64(F.lit(7), "basket").alias("basket"), "item")
    spark = pruned.sparkSession
    known = spark.createDataFrame(pa.table({"item": pa.array(vocabulary, pa.int64())}))
    kernel = _counted(vocabulary, np.searchsorted(vocabulary, codes).astype(np.int32))
    counts = (hashed.join(known, "item", "left_semi").select("block", "basket", "item")
              .repartition("block").sortWithinPartitions("block").mapInArrow(kernel, "candidate int, support long")
              .groupBy("candidate").agg(F.sum("support").alias("support")))
    named = spark.createDataFrame(pa.table({"candidate": pa.array(np.arange(len(codes)), pa.int32()),
                                            **{c: pa.array(codes[:, k], pa.int64()) for k, c in enumerate(columns)}}))
    return counts.join(named, "candidate").select(*columns, "support")
