"""Exact Jaccard of many pairs of texts, cell by cell.

A text that is in many pairs would cross an exchange once per pair, and be
compared with every partner anew. Texts are laid in *blocks* instead, those
with common partners in one, and pairs in *cells* of two blocks: a text goes
once to every cell that it is wanted in, its set is computed there once, and
where many pairs of a cell are wanted their intersections come from products
of 0/1 matrices (sets by tokens).

The layout decides what is done where, never what comes out: every pair lies in
the cell of its two blocks. A block holds ``BLOCK`` characters or so (a text at
least, short ones counting more), so that a large group is many blocks and its
cells many tasks' work.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import shingle_weights, text_shingle_hashes
from tessera.functions.sketches import BLOOM_BITS, Bloom
from tessera.operators.joins import pairs_within_groups, salted_join
from tessera.sources.storage import materialize, release

try:  # kernels are shipped by value, as in functions.hashing
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

BLOCK = 1 << 20   # weight of a block: characters, and LEAST a text
LEAST = 1 << 10   # so that a block has no more than 1024 texts
BUCKET = 1 << 22  # the same of the texts that come to a task's group at once
COLUMNS = 1 << 12  # tokens of a product


def common_counts(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common elements of ``sets[i]`` and ``sets[j]`` (sorted, distinct), pair by pair."""
    sizes = np.array([s.size for s in sets], dtype=np.int64)
    merge = lambda: np.array([_merged(sets[a], sets[b]) for a, b in zip(i.tolist(), j.tolist())], dtype=np.int64)
    left, right = np.unique(i), np.unique(j)
    # rough nanoseconds of each way; sums of float32 are whole up to 2^24
    merging = float(20_000 * i.size + 8 * (sizes[i] + sizes[j]).sum())
    sorting = 60.0 * sizes.sum()
    if merging < 2 * sorting or sizes.max(initial=0) >= 1 << 24:
        return merge()
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    opens = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    run = np.cumsum(opens) - 1
    shared = np.bincount(run)[run] > 1  # others are common to no two sets
    owner, run = owner[shared], run[shared]
    column = np.cumsum(np.concatenate(([True], run[1:] != run[:-1]))) - 1 if run.size else run
    columns = int(column[-1]) + 1 if column.size else 0
    if merging < (len(sets) + 0.04 * left.size * right.size) * columns:
        return merge()
    common = np.zeros((left.size, right.size), dtype=np.float32)
    same = left.size == right.size and bool((left == right).all())
    place = np.full((2, len(sets)), -1)
    place[0, left], place[1, right] = np.arange(left.size), np.arange(right.size)
    for start in range(0, columns, COLUMNS):
        at = slice(*np.searchsorted(column, (start, start + COLUMNS)).tolist())
        held = []
        for side, n in ((0, left.size), (1, right.size))[:1 if same else 2]:
            rows, there = place[side][owner[at]], np.zeros((n, min(COLUMNS, columns - start)), dtype=np.float32)
            known = rows >= 0
            there[rows[known], column[at][known] - start] = 1
            held.append(there)
        common += held[0] @ held[-1].T
    return common[place[0][i], place[1][j]].astype(np.int64)


def _merged(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate((x, y))
    both.sort(kind="stable")  # two sorted runs: one merge
    return int(np.count_nonzero(both[1:] == both[:-1]))


class _Sets:
    """Shingle sets of a bucket's texts by place, computed when they are first wanted."""

    def __init__(self, texts: pa.Table, weights: np.ndarray):
        self.ids, self.texts, self.weights = texts.column("text_id").combine_chunks(), texts.column("text"), weights
        self.held: dict[int, np.ndarray] = {}

    def places(self, ids: pa.ChunkedArray) -> np.ndarray:
        """Places of ids, -1 where there is no text."""
        return pc.fill_null(pc.index_in(ids, value_set=self.ids), -1).to_numpy().astype(np.int64)

    def similarity(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        wanted, where = np.unique(np.concatenate((i, j)), return_inverse=True)
        for at in wanted.tolist():
            if at not in self.held:
                self.held[at] = text_shingle_hashes(self.texts[at].as_py(), self.weights)
        sets = [self.held[at] for at in wanted.tolist()]
        sizes = np.array([s.size for s in sets], dtype=np.int64)
        i, j = where[:i.size], where[i.size:]
        common = common_counts(sets, i, j)
        return common / (sizes[i] + sizes[j] - common)


def _runs(cells: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the rows of each cell."""
    order = np.argsort(cells, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(cells[order])) + 1) if order.size else ()


def _listed(k: int, columns: list[str]):
    weights = np.array(shingle_weights(k), dtype=np.int64)

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = _Sets(texts, weights)
        first, second = sets.places(pairs.column("first")), sets.places(pairs.column("second"))
        known = np.flatnonzero((first >= 0) & (second >= 0))
        pairs, first, second = pairs.take(pa.array(known)), first[known], second[known]
        out = np.empty(known.size)
        for rows in _runs(pairs.column("_cell").to_numpy()):
            out[rows] = sets.similarity(first[rows], second[rows])
        return pairs.select(columns).append_column("similarity", pa.array(out))
    return run


def _whole(k: int, threshold: float):
    weights = np.array(shingle_weights(k), dtype=np.int64)

    def run(members: pa.Table, texts: pa.Table) -> pa.Table:
        sets = _Sets(texts, weights)
        place, side = sets.places(members.column("id")), members.column("side").to_numpy()
        size, cell = members.column("n").to_numpy(), members.column("_cell").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
        for rows in _runs(cell):
            rows = rows[place[rows] >= 0]
            left, right, both = (rows[side[rows] == s] for s in (0, 1, 2))  # 2: a block with itself
            for x, y in ((left, right), (both, both)):
                small, large = np.minimum(size[x][:, None], size[y]), np.maximum(size[x][:, None], size[y])
                able = small >= (threshold - 1e-9) * large
                a, b = np.nonzero(np.triu(able, 1) if x is both else able)
                if a.size:
                    i, j = place[x[a]], place[y[b]]
                    similar = sets.similarity(i, j)
                    hit = similar >= threshold
                    found.append((i[hit], j[hit], similar[hit]))
        i, j, similar = (np.concatenate(v) for v in zip(*found))
        x, y = sets.ids.take(pa.array(i)), sets.ids.take(pa.array(j))
        less = pc.less(x, y)
        return pa.Table.from_arrays([pc.if_else(less, x, y), pc.if_else(less, y, x), pa.array(similar)],
                                    names=["first", "second", "similarity"])
    return run


def lay_blocks(labelled: DataFrame) -> DataFrame:
    """``(id, n, label, block)``, stored, of ``(id, n, label)``: texts of one label in blocks of about ``BLOCK``."""
    weight = F.col("n").cast("long") + F.lit(LEAST)
    cuts = labelled.groupBy("label").agg(F.ceil(F.sum(weight) / F.lit(BLOCK)).cast("long").alias("_b"))
    return materialize(labelled.join(cuts, "label").select(
        "id", "n", "label", F.xxhash64("label", F.pmod(F.xxhash64("id"), F.col("_b"))).alias("block")), "blocks")


def _cell(a: Column, b: Column) -> Column:
    return F.xxhash64(F.least(a, b), F.greatest(a, b))


def _buckets(spark, weight: int | None) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((weight or 0) / BUCKET))


def _sent(wanted: DataFrame, needs: DataFrame, buckets: int) -> DataFrame:
    """``(_bucket, text_id, text)``: each text once to every bucket with a cell that needs it (``needs``: ``id, _cell``)."""
    return (needs.select(F.pmod("_cell", F.lit(buckets)).alias("_bucket"), "id").distinct().join(wanted, "id")
            .select("_bucket", F.col("id").alias("text_id"), "text"))


def listed_similarity(pairs: DataFrame, docs: DataFrame, k: int, id_col: str = "doc_id", bits: int = BLOOM_BITS,
                      behind: list[DataFrame] | None = None) -> DataFrame:
    """``pairs`` (``first``, ``second``, ...) with the exact ``similarity`` of their texts; stored tables that it reads go to ``behind``."""
    docs = docs.select(F.col(id_col).alias("id"), "text")
    ends = (pairs.select(F.col("first").alias("id"), F.col("second").alias("other"))
            .unionByName(pairs.select(F.col("second").alias("id"), F.col("first").alias("other"))))
    labels = materialize(ends.groupBy("id").agg(F.min("other").alias("other"))
                         .select("id", F.least("id", "other").alias("label")), "cell_labels")
    # the label of the label: those who know each other over a third
    onward = labels.select(F.col("id").alias("label"), F.col("label").alias("_next"))
    wanted = materialize(docs.filter(Bloom.of(labels, "id", bits).may_hold("id")), "cell_docs")
    blocks = lay_blocks(labels.join(onward, "label").join(wanted.select("id", F.length("text").alias("n")), "id").select("id", "n", F.col("_next").alias("label")))
    of = lambda c: blocks.select(F.col("id").alias(c), F.col("block").alias(f"_b_{c}"), F.col("n").alias(f"_n_{c}"))
    placed = materialize(pairs.join(of("first"), "first").join(of("second"), "second").select(
        *pairs.columns, _cell(F.col("_b_first"), F.col("_b_second")).alias("_cell"), "_n_first", "_n_second"), "cell_pairs")
    needs = materialize(placed.select("_cell", F.col("first").alias("id"), F.col("_n_first").alias("n")).unionByName(
        placed.select("_cell", F.col("second").alias("id"), F.col("_n_second").alias("n"))).distinct(), "cell_texts",
        {"weight": F.sum(F.col("n").cast("long") + F.lit(LEAST))})
    buckets = _buckets(docs.sparkSession, needs._tessera_metrics["weight"])
    texts = _sent(wanted, needs, buckets)
    by_bucket = placed.select(*pairs.columns, "_cell", F.pmod("_cell", F.lit(buckets)).alias("_bucket"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)
    if behind is not None:
        behind += [labels, wanted, blocks, placed, needs]
    return (by_bucket.repartition(buckets, "_bucket").groupBy("_bucket").cogroup(texts.repartition(buckets, "_bucket").groupBy("_bucket"))
            .applyInArrow(_listed(k, pairs.columns), f"{kinds}, similarity double"))


def whole_cells(rows: DataFrame, docs: DataFrame, threshold: float, k: int, largest: int,
                bits: int = BLOOM_BITS) -> tuple[DataFrame, DataFrame]:
    """Pairs that share a group: ``(first, second, similarity)`` of those that reach the threshold, stored.

    ``rows`` are ``(part, id, n)``: members of groups, at most ``largest`` of
    one, and the sizes of their sets. Pairs of a group are not written down.
    Members of groups that hang together have one label, the least id found
    in two steps, and all pairs of a label are compared. Members of two labels
    that meet in a group are compared in the cell of their blocks. The second
    table, stored too, is ``(id, n, label, block)``.
    """
    docs = docs.select(F.col("doc_id").alias("id"), "text")
    least = lambda df, c: df.join(df.groupBy("part").agg(F.min(c).alias("_least")), "part")
    near = materialize(least(rows, "id").groupBy("id").agg(F.max("n").alias("n"), F.min("_least").alias("label")), "cell_labels")
    onward = least(rows.select("part", "id").join(near.select("id", "label"), "id"), "label").groupBy("id").agg(F.min("_least").alias("label"))
    blocks = lay_blocks(near.select("id", "n").join(onward, "id"))
    own = blocks.select("label", "block").distinct()
    along = pairs_within_groups(own, ["label"], "block").select("first", "second").distinct()
    sides = along.select(_cell(F.col("first"), F.col("second")).alias("_cell"), F.explode(F.array(
        F.struct(F.col("first").alias("block"), F.lit(0).alias("side")), F.struct(F.col("second").alias("block"), F.lit(1).alias("side")))).alias("s"))
    inside = (sides.select("_cell", "s.block", "s.side").join(blocks.select("block", "id", "n"), "block")
              .unionByName(blocks.select(_cell(F.col("block"), F.col("block")).alias("_cell"), "block", F.lit(2).alias("side"), "id", "n")))
    placed = rows.select("part", "id").join(blocks, "id")
    mixed = placed.groupBy("part").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high").select("part")
    mixed = materialize(placed.join(mixed, "part", "left_semi"), "mixed_groups")
    others = mixed.select("part", F.col("label").alias("_label"), F.col("block").alias("_block")).distinct()
    across = (salted_join(mixed, others, ["part"], largest).filter("label <> _label and block <> _block")
              .select(_cell(F.col("block"), F.col("_block")).alias("_cell"), "block", F.when(F.col("block") < F.col("_block"), 0).otherwise(1).alias("side"),
                      "id", "n").distinct())
    needs = materialize(inside.unionByName(across).select("_cell", "side", "id", "n"), "cell_texts",
                        {"weight": F.sum(F.col("n").cast("long") + F.lit(LEAST))})
    buckets = _buckets(docs.sparkSession, needs._tessera_metrics["weight"])
    texts = _sent(docs.filter(Bloom.of(blocks, "id", bits).may_hold("id")), needs, buckets)
    by_bucket = needs.withColumn("_bucket", F.pmod("_cell", F.lit(buckets)))
    kind = dict(rows.dtypes)["id"]
    found = (by_bucket.repartition(buckets, "_bucket").groupBy("_bucket").cogroup(texts.repartition(buckets, "_bucket").groupBy("_bucket"))
             .applyInArrow(_whole(k, float(threshold)), f"first {kind}, second {kind}, similarity double"))
    found = materialize(found, "whole_cells")
    on = lambda side: F.count_if(F.col("side") == side)
    compared = (needs.groupBy("_cell").agg((on(0) * on(1) + on(2) * (on(2) - 1) / 2).alias("n"))
                .agg(F.sum("n").alias("n")).first()["n"])
    found._tessera_metrics["compared"] = int(compared or 0)
    release(near, mixed, needs)
    return found, blocks
