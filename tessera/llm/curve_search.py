"""Nearest neighbours over shifted space-filling curves.

Vectors are turned into the axes of their covariance. Every curve projects
them onto a few seeded orthonormal directions of the leading axes, shifts the
projections on a grid of its own and takes the cell's place on a Hilbert curve
as key. Spark range-partitions the vectors by that key and cuts them, in
order, into blocks; a query is compared with the vectors of its own and the
neighbouring blocks, curve by curve, and the curves' findings merge. What is
near in space is near on at least one of several curves, if the space has few
directions that matter.

Where it has many (random directions), no window is sure to hold the nearest
vectors. The merged findings bound the distance that still matters, so the
second part completes them: the blocks of the first curve carry bounding
boxes, the queries are taken through the blocks in portions, and a block is
opened only for queries whose bound reaches its box. With it the result is
exact; ``complete=False`` stops after the windows, and ``recall`` of the two
is measured in the tests.

Equal vectors are one class with its ``k + 1`` smallest ids, so a vector that
a third of all rows share is compared once. A curve's blocks are deleted when
its windows are done (the first curve's stay for the completion).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.storage import materialize, release

K = 10
CURVES = 4
PROJECTED = 8     # directions of a curve
BITS = 7          # of a grid coordinate: a key has PROJECTED * BITS
BLOCK = 512       # vectors of a block
PORTION = 8192    # queries taken through the blocks at a time
SEED = 11
ROUNDING = 1e-9   # of a squared distance from products, relative to the squared lengths

_BLOCK_DDL = ("dim int, task int, place long, cids binary, lows binary, copies binary, vectors binary, asked binary, "
              "asked_vectors binary, box binary")
_FOUND_DDL = "query long, cid long, low long, copies long, distance double"


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows of whole numbers below ``2^bits``) on the Hilbert curve through the grid."""
    x = [grid[:, i].astype(np.int64) for i in range(grid.shape[1])]
    n = len(x)
    for bit in range(bits - 1, 0, -1):  # undo the turns of the sub-cubes
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap
    for i in range(1, n):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn = np.where(x[n - 1] & (1 << bit), turn ^ ((1 << bit) - 1), turn)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ turn) >> bit) & 1)
    return key


class Axes:
    """Centre, axes by falling variance and standard deviations of the vectors of one length."""

    def __init__(self, n: int, total: np.ndarray, products: np.ndarray):
        self.centre = total / n
        values, axes = np.linalg.eigh(products / n - np.outer(self.centre, self.centre))
        self.turn = axes[:, ::-1].copy()
        self.spread = np.sqrt(np.maximum(values[::-1], 0))

    def turned(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) @ self.turn

    def keys(self, turned: np.ndarray, curve: int) -> np.ndarray:
        dim = turned.shape[1]
        rng = np.random.default_rng((SEED, curve, dim))
        width = min(dim, PROJECTED)
        among = min(dim, 4 * PROJECTED)
        directions = np.linalg.qr(rng.standard_normal((among, among)))[0][:, :width]
        spread = np.sqrt((self.spread[:among, None] ** 2 * directions ** 2).sum(axis=0))
        y = (turned[:, :among] @ directions) / np.where(spread > 0, spread, 1)
        # six standard deviations on three quarters of the grid, the rest is room for the shift
        cells = (1 << BITS) * ((np.clip(y, -3, 3) + 3) / 8 + rng.random(width) / 4)
        return hilbert_keys(np.minimum(cells, (1 << BITS) - 1), BITS)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, rows in _by_length(batch):
            x = np.hstack([_matrix(rows.column("vector"), d), np.ones((rows.num_rows, 1))])
            sums[d] = sums.get(d, 0) + x.T @ x
    for d, m in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.reshape(-1)], pa.list_(pa.float64()))],
                                         names=["dim", "m"])


def covariance_axes(classes: DataFrame) -> dict[int, Axes]:
    """Per vector length the axes, from sums over all vectors; one matrix a length reaches the driver."""
    sums = (classes.select("dim", "vector").mapInArrow(_moments, "dim int, m array<double>")
            .select("dim", F.posexplode("m").alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v"))
            .groupBy("dim").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("m")))
    out = {}
    for row in sums.toLocalIterator():
        m = np.array(row["m"]).reshape(row["dim"] + 1, row["dim"] + 1)
        out[row["dim"]] = Axes(int(round(m[-1, -1])), m[-1, :-1], m[:-1, :-1])
    return out


def _keyed(axes: dict[int, Axes], curve: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows in _by_length(batch):
                keys = axes[d].keys(axes[d].turned(_matrix(rows.column("vector"), d)), curve)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys)], names=[*rows.schema.names, "key"])
    return run


def _blocks(axes: dict[int, Axes]):
    """Cuts ordered classes into blocks of one length; ``place`` counts a task's blocks."""
    def block(dim: int, task: int, place: int, rows: pa.Table) -> pa.RecordBatch:
        x = _matrix(rows.column("vector").combine_chunks(), dim)
        asked = rows.column("asked").to_numpy()
        turned = axes[dim].turned(x)
        ids = {c: rows.column(c).to_numpy().astype("<i8") for c in ("cid", "low", "copies")}
        values = [ids["cid"], ids["low"], ids["copies"], x, ids["cid"][asked], x[asked],
                  np.stack([turned.min(axis=0), turned.max(axis=0)])]
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([task], pa.int32()), pa.array([place], pa.int64()),
             *[pa.array([v.tobytes()], pa.binary()) for v in values]],
            names=["dim", "task", "place", "cids", "lows", "copies", "vectors", "asked", "asked_vectors", "box"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place, now, held = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            for d, rows in _by_length(batch):  # the order is by length first
                if held is not None and d != now:
                    yield block(now, task, place, held)
                    place, held = place + 1, None
                now = d
                rows = pa.Table.from_batches([rows])
                held = rows if held is None else pa.concat_tables([held, rows])
                while held.num_rows > BLOCK:
                    yield block(now, task, place, held.slice(0, BLOCK))
                    place, held = place + 1, held.slice(BLOCK)
        if held is not None and held.num_rows:
            yield block(now, task, place, held)
    return run


def ordered_blocks(classes: DataFrame, axes: dict[int, Axes], curve: int) -> tuple[DataFrame, DataFrame]:
    """The stored blocks of one curve, and the same with ``number`` counting them along the curve within a length."""
    columns = ["dim", "cid", "low", "copies", "asked", "vector"]
    kind = dict(classes.dtypes)["vector"]
    keyed = classes.select(*columns).mapInArrow(
        _keyed(axes, curve), f"dim int, cid long, low long, copies long, asked boolean, vector {kind}, key long")
    order = ["dim", "key", "cid"]
    blocks = materialize(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(axes), _BLOCK_DDL),
                         "curve-blocks")
    # one row per task and length: where the task's blocks begin
    counts = blocks.groupBy("dim", "task").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    starts = counts.select("dim", "task", "first", F.coalesce(F.sum("n").over(
        Window.partitionBy("dim").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return blocks, blocks.join(starts, ["dim", "task"]).withColumn("number", F.col("start") + F.col("place") - F.col("first"))


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of paired rows, summed coordinate by coordinate in order."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - y[:, j]
        total += d * d
    return np.sqrt(total)


class _Block:
    """The vectors of a block and what is needed for distances to them."""

    def __init__(self, dim: int, cids: bytes, lows: bytes, copies: bytes, vectors: bytes):
        self.cids, self.lows, self.copies = (np.frombuffer(v, "<i8") for v in (cids, lows, copies))
        self.x = np.frombuffer(vectors, "<f8").reshape(-1, dim)
        self.squares = np.einsum("ij,ij->i", self.x, self.x)

    def nearest(self, queries: np.ndarray, bounds: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, row, distance)``: per query the rows that may be among its ``take`` nearest, none beyond its bound."""
        lengths = np.einsum("ij,ij->i", queries, queries)
        squared = lengths[:, None] + self.squares[None, :] - 2 * (queries @ self.x.T)
        slack = ROUNDING * (lengths[:, None] + self.squares.max())
        limit = (bounds ** 2)[:, None] * (1 + ROUNDING) + slack
        if squared.shape[1] > take:
            limit = np.minimum(limit, np.partition(squared, take - 1, axis=1)[:, take - 1:take] + 2 * slack)
        q, r = np.nonzero(squared <= limit)
        return q, r, _exact(queries[q], self.x[r])


def _best(found: list[np.ndarray], take: int) -> list[np.ndarray]:
    """Of ``[query, cid, low, copies, distance]`` the ``take`` nearest classes of each query, ties to the smaller low."""
    query, cid, low, _, distance = found
    order = np.lexsort((cid, low, distance, query))
    starts = np.flatnonzero(np.concatenate([[True], query[order][1:] != query[order][:-1]])) if len(order) else np.zeros(0, int)
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    keep = order[nth < take]
    return [v[keep] for v in found]


def _rows(found: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in found], names=["query", "cid", "low", "copies", "distance"])


def _windows(take: int):
    """Queries of a block against one block of its window."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("dim", "cids", "lows", "copies", "vectors", "queries", "query_vectors")
        for batch in batches:
            for dim, *of, queries, vectors in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                block, ids = _Block(dim, *of), np.frombuffer(queries, "<i8")
                x = np.frombuffer(vectors, "<f8").reshape(-1, dim)
                q, r, distance = block.nearest(x, np.full(len(x), np.inf), take)
                yield _rows(_best([ids[q], block.cids[r], block.lows[r], block.copies[r], distance], take))
    return run


def window_findings(blocks: DataFrame, take: int) -> DataFrame:
    """Every query's nearest classes in its own and the two neighbouring blocks of a curve."""
    asked = (blocks.filter(F.length("asked") > 0)
             .select("dim", F.explode(F.array(F.col("number") - 1, F.col("number"), F.col("number") + 1)).alias("number"),
                     F.col("asked").alias("queries"), F.col("asked_vectors").alias("query_vectors")))
    sides = blocks.select("dim", "number", "cids", "lows", "copies", "vectors").join(asked, ["dim", "number"])
    return sides.mapInArrow(_windows(take), _FOUND_DDL)


def _merged(found: DataFrame, take: int) -> DataFrame:
    """The ``take`` nearest classes of each query, found once or several times."""
    order = Window.partitionBy("query").orderBy("distance", "low", "cid")
    return (found.dropDuplicates(["query", "cid"]).withColumn("nth", F.row_number().over(order))
            .filter(F.col("nth") <= take))


def _bounds(merged: DataFrame, take: int) -> DataFrame:
    """``query, bound``: the distance within which the query has ``take`` rows already."""
    so_far = F.sum("copies").over(Window.partitionBy("query").orderBy("nth"))
    return (merged.withColumn("rows", so_far).filter(F.col("rows") >= take)
            .groupBy("query").agg(F.min("distance").alias("bound")))


def _completed(portion, axes: dict[int, Axes], take: int):
    """What the blocks hold within the queries' bounds; ``portion`` has per length ids, vectors and bounds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = portion.value
        turned = {d: axes[d].turned(x) for d, (_, x, _) in queries.items()}
        found = None
        names = ("dim", "box", "cids", "lows", "copies", "vectors")
        for batch in batches:
            for dim, box, *of in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if dim not in queries:
                    continue
                ids, x, bounds = queries[dim]
                low, high = np.frombuffer(box, "<f8").reshape(2, dim)
                y = turned[dim]
                gap = np.maximum(0, np.maximum(low - y, y - high))
                reach = np.flatnonzero(np.einsum("ij,ij->i", gap, gap) <= (bounds * (1 + ROUNDING) + ROUNDING * (1 + np.abs(y).max(axis=1))) ** 2)
                if not len(reach):
                    continue
                block = _Block(dim, *of)
                q, r, distance = block.nearest(x[reach], bounds[reach], take)
                near = distance <= bounds[reach][q]
                q, r, distance = q[near], r[near], distance[near]
                some = [ids[reach][q], block.cids[r], block.lows[r], block.copies[r], distance]
                found = some if found is None else [np.concatenate(v) for v in zip(found, some, strict=True)]
                if len(found[0]) > 4 * take * PORTION:
                    found = _best(found, take)
        if found is not None:
            yield _rows(_best(found, take))
    return run


def _complete(classes: DataFrame, blocks: DataFrame, bounds: DataFrame, axes: dict[int, Axes], take: int) -> DataFrame | None:
    """The queries, in portions, through the blocks whose boxes they reach."""
    spark = classes.sparkSession
    queries = materialize(
        classes.filter("asked").select("dim", F.col("cid").alias("query"), "vector").join(bounds, "query", "left")
        .select("dim", "query", "vector", F.coalesce("bound", F.lit(float("inf"))).alias("bound")), "curve-queries")
    portions = -(-queries._tessera_rows // PORTION)
    out = None
    for p in range(portions):
        rows = queries.filter(F.pmod(F.xxhash64("query"), F.lit(portions)) == p).toArrow()  # PORTION queries on average
        held = {}
        for d, some in _by_length(rows.combine_chunks().to_batches()[0]) if rows.num_rows else ():
            held[d] = (some.column("query").to_numpy(zero_copy_only=False), _matrix(some.column("vector"), d),
                       some.column("bound").to_numpy(zero_copy_only=False))
        shipped = spark.sparkContext.broadcast(held)
        found = materialize(blocks.select("dim", "box", "cids", "lows", "copies", "vectors")
                            .mapInArrow(_completed(shipped, axes, take), _FOUND_DDL), "curve-complete")
        shipped.destroy()
        out = found if out is None else out.unionByName(found)
    release(queries)
    return out


def nearest_neighbours(vectors: DataFrame, queries, key: str = "vec_id", embedding: str = "embedding", k: int = K,
                       curves: int = CURVES, complete: bool = True) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows nearest to each query row, by Euclidean distance.

    ``queries`` is a condition on the ``key`` column; the rows that meet it
    are the queries, every other row but the query's own is a candidate.
    Distances are taken in double precision on the given vectors; ties go to
    the smaller key. Null and empty vectors, zero vectors, vectors with null,
    NaN or infinite components and rows without a key take no part, and
    vectors of another length are no candidates. Rows that repeat a key are
    rows of their own: each is a candidate for the other and, as a query, has
    its own result. Fewer than ``k`` candidates are all returned; an empty
    table gives no rows; further columns are not read.
    """
    spark = vectors.sparkSession
    take = k + 1  # a query's own row may be among the nearest
    v = F.col(embedding)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col(key).isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.filter(usable).select(F.col(key).cast("long").alias("vec_id"), v.alias("vector")).withColumn(
        "h", F.xxhash64("vector"))
    asked = queries(F.col("vec_id"))
    # per class the smallest ids of all and whether a query is in it (both cut before the shuffle)
    few = rows.withColumn("nth", F.row_number().over(Window.partitionBy("h", "vector").orderBy("vec_id"))).filter(F.col("nth") <= take)
    members = few.groupBy("h", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    wanted = rows.filter(asked).select("h", "vector").distinct().withColumn("asked", F.lit(True))
    classes = materialize(
        members.join(wanted, ["h", "vector"], "left").select(
            F.monotonically_increasing_id().alias("cid"), "h", "vector", "members", F.element_at("members", 1).alias("low"),
            F.size("members").cast("long").alias("copies"), F.coalesce("asked", F.lit(False)).alias("asked"),
            F.size("vector").alias("dim")), "curve-classes", {"asked": F.count_if("asked")})
    empty = "query_id long, rank int, vec_id long, score double"
    if not classes._tessera_metrics["asked"]:
        release(classes)
        return spark.createDataFrame([], empty)
    axes = covariance_axes(classes)
    found, kept, first, numbered = None, [], None, None
    for curve in range(curves):
        blocks, along = ordered_blocks(classes, axes, curve)
        some = materialize(window_findings(along, take), "curve-windows")
        found = some if found is None else found.unionByName(some)
        kept.append(some)
        if curve == 0 and complete:
            first, numbered = blocks, along
        else:
            release(blocks)
    merged = materialize(_merged(found, take), "curve-merged")
    release(*kept)
    if complete:
        more = _complete(classes, numbered.select("dim", "box", "cids", "lows", "copies", "vectors"), _bounds(merged, take), axes, take)
        release(first)
        merged = materialize(_merged(merged.drop("nth").unionByName(more), take), "curve-merged")
    near = merged.join(classes.select("cid", "members"), "cid").select("query", "distance", F.explode("members").alias("vec_id"))
    near = (near.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id")))
            .filter(F.col("nth") <= take).groupBy("query")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("distance").alias("score"), "vec_id"))).alias("near")))
    near = materialize(near.join(classes.select(F.col("cid").alias("query"), "h", "vector"), "query"), "curve-near")
    # the query's own row goes out of its class's list, once
    own = F.array_position("near", F.struct(F.lit(0.0).alias("score"), F.col("vec_id")))
    others = F.when(own > 0, F.concat(F.slice("near", F.lit(1), (own - 1).cast("int")), F.slice("near", (own + 1).cast("int"), F.lit(take)))).otherwise(F.col("near"))
    out = (rows.filter(asked).join(near.select("h", "vector", "near"), ["h", "vector"])
           .select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "n"))
           .select("query_id", (F.col("at") + 1).alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score")))
    return out


def op11(embeddings: DataFrame) -> DataFrame:
    return nearest_neighbours(embeddings, lambda key: key % 100 == 0)
