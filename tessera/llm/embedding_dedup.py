"""Near-duplicate vectors by PCA-ordered tiled comparison.

All vectors are rotated into the axes of their second moments (cosines stay
the same), so the leading coordinates carry most of every inner product. Two
unit vectors of cosine ``t`` lie at most ``w = sqrt(2 - 2 t)`` apart, in every
coordinate too: vectors are ordered by label, strip of the first coordinate
(``w`` wide) and second coordinate, and cut into tiles; only tiles whose
bounding boxes are at most ``w`` apart are compared. Inside a pair of tiles
the inner products of the first few coordinates are accumulated for all
pairs, the rest is bounded by the product of the suffix norms, and a pair is
left as soon as its cosine can't reach the threshold. Survivors go on to the
next coordinates; the last word has the cosine of the given vectors in double
precision. Equal vectors of a label are one row from the start, and a pair of
tiles reports a count and one tree edge per vector, so large groups of copies
or near copies don't multiply rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.storage import materialize

from .graph import connected_components

THRESHOLD = 0.98
TILE = 512
STEPS = (8, 16, 32)   # coordinates after which pairs are given up
BOX = 8               # leading coordinates with a bounding box per tile
SLACK = 1e-9          # for the rounding of rotated products

_TILE_DDL = ("label string, dim int, strip long, tile string, lo array<double>, hi array<double>, "
             "cids binary, copies binary, vectors binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of extreme values finite
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            x = _unit(_matrix(batch.column(1).filter(pa.array(dims == d)), int(d)))
            sums[int(d)] = sums.get(int(d), 0) + x.T @ x
    for d, m in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.reshape(-1)], pa.list_(pa.float64()))],
                                         names=["dim", "m"])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The axes of every vector length, by falling second moment, from sums over all ``(dim, embedding)`` rows.

    What reaches the driver is one matrix per length, whatever the number of
    vectors.
    """
    sums = (vectors.select("dim", "embedding").mapInArrow(_moments, "dim int, m array<double>")
            .select("dim", F.posexplode("m").alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v"))
            .groupBy("dim").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("m")))
    axes = {}
    for row in sums.toLocalIterator():
        _, q = np.linalg.eigh(np.array(row["m"]).reshape(row["dim"], row["dim"]))
        axes[row["dim"]] = q[:, ::-1].copy()
    return axes


def _placed(axes: dict[int, np.ndarray], width: float):
    """Adds the strip of the first coordinate and the second coordinate."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            strip, second = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for d in np.unique(dims):
                of = dims == d
                y = _unit(_matrix(batch.column("embedding").filter(pa.array(of)), int(d))) @ axes[int(d)][:, :2]
                strip[of] = np.floor(y[:, 0] / width)
                second[of] = y[:, -1] if d > 1 else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(strip), pa.array(second)],
                                             names=[*batch.schema.names, "strip", "second"])
    return run


def _tiles(axes: dict[int, np.ndarray], size: int):
    """Cuts ordered rows into tiles of one label, length and strip."""
    def tile(key: tuple, cids: list, copies: list, vectors: list) -> pa.RecordBatch:
        label, dim, strip = key
        x = np.array(vectors, dtype=np.float64)
        y = _unit(x) @ axes[dim][:, :BOX]
        return pa.RecordBatch.from_arrays([
            pa.array([label], pa.string()), pa.array([dim], pa.int32()), pa.array([strip], pa.int64()),
            pa.array([f"{cids[0]}"], pa.string()),  # the first class names the tile
            pa.array([y.min(axis=0)], pa.list_(pa.float64())), pa.array([y.max(axis=0)], pa.list_(pa.float64())),
            pa.array([np.array(cids, "<i8").tobytes()], pa.binary()),
            pa.array([np.array(copies, "<i8").tobytes()], pa.binary()),
            pa.array([x.astype("<f8").tobytes()], pa.binary())],
            names=["label", "dim", "strip", "tile", "lo", "hi", "cids", "copies", "vectors"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("label", "dim", "strip")], strict=True))
            rows = zip(keys, batch.column("cid").to_pylist(), batch.column("copies").to_pylist(),
                       (v.values.to_numpy(zero_copy_only=False) for v in batch.column("embedding")), strict=True)
            for key, *values in rows:
                if held[0] and (key != now or len(held[0]) >= size):
                    yield tile(now, *held)
                    held = ([], [], [])
                now = key
                for column, value in zip(held, values, strict=True):
                    column.append(value)
        if held[0]:
            yield tile(now, *held)
    return run


def possible_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rotated unit rows whose cosine can reach ``threshold``, by accumulating leading coordinates."""
    dim = a.shape[1]
    steps = [s for s in STEPS if s < dim] + [dim]
    suffix = lambda y, k: np.sqrt(np.maximum(0, np.einsum("ij,ij->i", y[:, k:], y[:, k:])))
    k = steps[0]
    bound = a[:, :k] @ b[:, :k].T
    alive = bound + np.outer(suffix(a, k), suffix(b, k)) >= threshold - SLACK
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    sums = bound[i, j]
    for before, k in zip(steps[:-1], steps[1:], strict=True):
        if not len(i):
            break
        sums = sums + np.einsum("ij,ij->i", a[i, before:k], b[j, before:k])
        rest = suffix(a, k)[i] * suffix(b, k)[j] if k < dim else 0
        alive = sums + rest >= threshold - SLACK
        i, j, sums = i[alive], j[alive], sums[alive]
    return i, j


def _tree(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of ``n`` over the links ``(i, j)``."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[i], low[j])
        after = low.copy()
        np.minimum.at(after, i, m)
        np.minimum.at(after, j, m)
        after = after[after]
        if np.array_equal(after, low):
            return low
        low = after


def _compared(axes: dict[int, np.ndarray], threshold: float):
    """``(cid, hub, links)`` for every vector of a pair of tiles that links with another of the pair."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("dim", "same", "cids_a", "copies_a", "vectors_a", "cids_b", "copies_b", "vectors_b")
            for dim, same, ca, na, va, cb, nb, vb in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                ca, na, cb, nb = (np.frombuffer(x, "<i8") for x in (ca, na, cb, nb))
                xa, xb = (np.frombuffer(x, "<f8").reshape(-1, dim) for x in (va, vb))
                i, j = possible_pairs(_unit(xa) @ axes[dim], _unit(xb) @ axes[dim], threshold, same)
                ua, ub = (x / np.abs(x).max(axis=1, keepdims=True) for x in (xa, xb))
                dots = np.einsum("ij,ij->i", ua[i], ub[j])
                norms = np.sqrt(np.einsum("ij,ij->i", ua, ua)[i]) * np.sqrt(np.einsum("ij,ij->i", ub, ub)[j])
                linked = dots / norms >= threshold
                i, j = i[linked], j[linked]
                if not len(i):
                    continue
                cids = ca if same else np.concatenate([ca, cb])
                copies = na if same else np.concatenate([na, nb])
                j = j if same else j + len(ca)
                order = np.argsort(cids)  # so that the smallest position is the smallest class
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                links = (np.bincount(i, copies[j], len(cids)) + np.bincount(j, copies[i], len(cids))).astype(np.int64)
                hub = cids[order][_tree(len(cids), place[i], place[j])][place]
                of = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(cids[of]), pa.array(hub[of]), pa.array(links[of])],
                                                 names=["cid", "hub", "links"])
    return run


def _tile_pairs(tiles: DataFrame, width: float) -> DataFrame:
    """Names of the tiles to compare: same label and length, boxes at most ``width`` apart."""
    box = tiles.select("label", "dim", "strip", "tile", "lo", "hi")
    second = lambda side: F.coalesce(F.get(F.col(side), F.lit(1)), F.lit(0.0))
    band = lambda side: F.floor(second(side) / width)
    left = box.select(
        "label", "dim", F.col("tile").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"),
        F.col("strip").alias("strip_a"), band("lo").alias("first_a"), band("hi").alias("last_a"),
        F.explode(F.array("strip", F.col("strip") + 1)).alias("strip"))
    left = left.withColumn("band", F.explode(F.sequence(F.col("first_a") - 1, F.col("last_a") + 1)))
    right = box.select("label", "dim", "strip", F.col("tile").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"),
                       band("lo").alias("first_b"), F.explode(F.sequence(band("lo"), band("hi"))).alias("band"))
    gaps = F.transform(F.arrays_zip("lo_a", "hi_a", "lo_b", "hi_b"), lambda z: F.greatest(
        z["lo_b"] - z["hi_a"], z["lo_a"] - z["hi_b"], F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)
    return (left.join(right, ["label", "dim", "strip", "band"])
            # two tiles may share several bands: the first of them counts
            .filter(F.col("band") == F.greatest(F.col("first_a") - 1, F.col("first_b")))
            .filter((F.col("strip") > F.col("strip_a")) | (F.col("a") <= F.col("b")))
            .filter(apart <= (width + SLACK) ** 2)
            .select("label", "dim", "a", "b"))


def near_duplicate_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                           threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``(key, n_links, component_id, kept)``, one row per row of ``vectors``.

    Links join rows of one non-null label (and one vector length) whose
    cosine is at least ``threshold``; ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest key reachable. Null vectors,
    vectors with null, infinite or NaN components, zero and empty vectors and
    rows with a null label link with nothing. Rows that repeat a key are rows
    of their own. A null key names no component and is kept only if its
    component has no other name. An empty table gives no rows; further
    columns are not read.
    """
    v = F.col(embedding).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = (F.col(label).isNotNull() & F.col(embedding).isNotNull()
              & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.when(usable, v).alias("embedding"))
    rows = materialize(rows.withColumn("cid", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding"))),
                       "vectors")
    classes = materialize(
        rows.filter("cid is not null").groupBy("cid").agg(
            F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("embedding")), "vector-classes")
    axes = principal_axes(classes)
    width = float(np.sqrt(2 - 2 * threshold))

    columns = classes.select("cid", "copies", "label", "dim", "embedding")
    placed = materialize(columns.mapInArrow(
        _placed(axes, width), "cid long, copies long, label string, dim int, embedding array<double>, strip long, "
        "second double"), "vectors-placed")
    order = ["label", "dim", "strip", "second", "cid"]
    tiles = materialize(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                        .mapInArrow(_tiles(axes, tile), _TILE_DDL), "vector-tiles")
    pairs = _tile_pairs(tiles, width)
    side = lambda s: tiles.select(F.col("tile").alias(s), *[F.col(c).alias(f"{c}_{s}")
                                                            for c in ("cids", "copies", "vectors")])
    found = materialize(
        pairs.join(side("a"), "a").join(side("b"), "b").withColumn("same", F.col("a") == F.col("b"))
        .mapInArrow(_compared(axes, threshold), "cid long, hub long, links long"), "vector-links")
    comps = connected_components(found.select(F.col("cid").alias("a"), F.col("hub").alias("b")).distinct())

    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (classes.select("cid", "rep", "copies").join(counts, "cid", "left")
             .join(comps, F.col("cid") == F.col("node"), "left")
             .select("cid", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("comp", "cid").alias("comp")))
    names = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = materialize(named.join(names, "comp").select(F.col("cid").alias("class"), "n_links", "component_id"),
                        "vector-names")
    out = (rows.select("vec_id", "cid").join(named, F.col("cid") == F.col("class"), "left")
           .withColumn("component_id", F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))))
    return out.select(F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def op7(embeddings: DataFrame) -> DataFrame:
    return near_duplicate_vectors(embeddings)
