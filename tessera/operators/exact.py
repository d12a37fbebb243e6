"""Exact all-pairs Jaccard join without a cross join (prefix index with filters).

One order holds for all tokens: ascending count in a count-min sketch, then
token value. The sketch is never below the true count, of a size that is a
parameter, and shipped to the kernels, so that every set sorts its tokens and
cuts its prefix in its own row: no token is exchanged or ranked across rows.
(Any order is valid; counts only make the prefixes of rare tokens.)

Let ``J(X, Y) >= t`` and ``|X| >= |Y|``. Then the two share at least
``a = ceil(t / (1 + t) (|X| + |Y|))`` tokens, and

* *length*: ``|Y| >= t |X|``, so X and Y lie in the same or in neighbouring
  size buckets; the bucket is part of the join key;
* *prefix*: a shared token is among the first ``|X| - ceil(t |X|) + 1`` tokens
  of the larger set and the first ``|Y| - ceil(2 t / (1 + t) |Y|) + 1`` of the
  smaller one (of two equally large sets the greater id counts as larger);
* *place*: with m shared prefix tokens, the last at places i and j, the
  overlap is at most ``m + min(|X| - i - 1, |Y| - j - 1)``;
* *suffix*: the overlap is at most the sum over the hash classes of tokens of
  the smaller number of tokens that either set has in the class.

Pairs that pass all four are verified with the exact Jaccard, so the result
equals brute force. Tokens of sketch count 1 occur in one set and are left
out of the index.

A sketch of a fixed size tells less the more tokens there are, and prefixes of
tokens that are not rare meet by chance. :func:`exact_similar_texts`, for whole
corpora, joins on *parts* instead, which need no counts:

* Let b be the size class of the smaller set Y, and U the class's upper end.
  Then ``|X| + |Y| <= (1 + 1 / t) U``, and X and Y differ in at most
  ``d = (1 - t) / t U`` tokens.
* Both sets are cut by the hash of the token into the same
  ``m = d + 1 + e`` parts. A token in which they differ spoils one part, so
  at least ``e + 1`` parts are equal.
* Each set drops its ``e + 1 - c`` lowest parts by (tokens, hash of the
  tokens) and keeps the ``d + c`` others. This order depends on a part's content
  only: the ``c`` highest of the equal parts stand above ``e + 1 - c`` others in
  both sets and are dropped by neither. So the two share ``c`` kept parts: rows
  of their hashes.

Kept parts hold several tokens, so sets that aren't similar hardly ever share
``c`` of them, and parts of one set alone fall out after one exchange. Pairs
are counted over parts that at most ``CROWD`` sets share. Of the others, which
families of near copies share by the hundred, no pairs are made: such sets are
laid in blocks and compared block by block (:mod:`tessera.operators.cells`).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.functions.hashing import pieces, shingle_weights, text_shingle_hashes
from tessera.functions.sketches import WIDTH, Bloom, CountMin, places, slices
from tessera.operators.cells import whole_cells
from tessera.operators.joins import ensure_parallelism, salted_join
from tessera.operators.similarity import pair_similarity, size_test, text_pair_similarity
from tessera.sources.storage import materialize, release

try:  # kernels are shipped by value, as in functions.hashing
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

# ceil(t * n) is taken of (t * n - _EPS): the prefix can only get longer, which
# keeps the filter exact under floating-point rounding.
_EPS = 1e-9
CLASSES = 256   # hash classes of the suffix filter


def prefix_lengths(n: int, threshold: float) -> tuple[int, int]:
    """Tokens of a set of ``n`` looked up (as the larger of a pair) and indexed (as the smaller)."""
    whole = n - math.ceil(threshold * n - _EPS) + 1
    short = n - math.ceil(2 * threshold / (1 + threshold) * n - _EPS) + 1
    return min(n, whole), min(n, short)


def _read_sets(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    lengths = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return batch.column(0), lengths, batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _cut(threshold: float, sketch: CountMin):
    """A row per prefix token, and one without a token that has the set's class counts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, lengths, tokens = _read_sets(batch)
            counts, classes = sketch.counts(tokens), places(tokens, 2, CLASSES)
            rows, token, place, size, count, indexed, histogram = [], [], [], [], [], [], []
            end = 0
            for i, n in enumerate(lengths.tolist()):
                start, end = end, end + n
                if not n:
                    continue
                looked_up, short = prefix_lengths(n, threshold)
                first = np.lexsort((tokens[start:end], counts[start:end]))[:looked_up]
                common = np.flatnonzero(counts[start:end][first] > 1)
                first = first[common] + start
                held = np.bincount(classes[start:end], minlength=CLASSES)
                rows.append(np.full(len(first) + 1, i))
                token += [None, *tokens[first].tolist()]
                place.append(np.concatenate([[-1], common]))
                size.append(np.full(len(first) + 1, n))
                count.append(np.concatenate([[0], counts[first]]))
                indexed.append(np.concatenate([[False], common < short]))
                # a class too full for 16 bits leaves the set without a suffix filter
                histogram += [held.astype("<u2").tobytes() if held.max() < 65536 else None, *[None] * len(first)]
            if not rows:
                continue
            flat = lambda parts, kind: pa.array(np.concatenate(parts), kind)
            yield pa.RecordBatch.from_arrays(
                [ids.take(flat(rows, pa.int64())), pa.array(token, pa.int64()), flat(place, pa.int32()),
                 flat(size, pa.int32()), flat(count, pa.int64()), flat(indexed, pa.bool_()), pa.array(histogram, pa.binary())],
                names=["id", "token", "place", "size", "count", "indexed", "histogram"])
    return run


def prefix_tokens(sets: DataFrame, threshold: float, id_col: str = "doc_id", sketch: CountMin | None = None,
                  width: int = WIDTH) -> DataFrame:
    """``(id, token, place, size, count, indexed, histogram)``: prefix rows of every set, from its own row alone."""
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    frame = sets.select(F.col(id_col).alias("id"), "shingles")
    if sketch is None:
        sketch = CountMin.of(frame, "shingles", width)
    kind = dict(frame.dtypes)["id"]
    return frame.mapInArrow(_cut(float(threshold), sketch),
                            f"id {kind}, token long, place int, size int, count long, indexed boolean, histogram binary")


def _least_overlap(threshold: float) -> Column:
    return F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("nx") + F.col("ny")) - F.lit(_EPS))


@F.pandas_udf(T.IntegerType())
def _overlap_bound(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sum over the classes of the smaller count; null where a set has no counts."""
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), -1, np.int64)
    if known.any():
        x, y = (np.frombuffer(b"".join(v[known]), "<u2").reshape(-1, CLASSES) for v in (a, b))
        out[known] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    return pd.Series(out).where(known).astype("Int32")


def exact_candidate_pairs(prefixes: DataFrame, threshold: float, largest: int | None = None) -> DataFrame:
    """``(first, second)``: id pairs that pass the four filters, smaller id first.

    ``largest`` is an upper bound of the sets that share a prefix token (the
    largest sketch count); it tells whether the join needs salting.
    """
    t = float(threshold)
    # a little wider than the range of sizes, so that rounding can't separate sizes further than one bucket
    width = max(math.log(1 / t) * 1.001, 1e-6)
    rows = prefixes.filter("token is not null").withColumn("bucket", F.floor(F.log(F.col("size").cast("double")) / F.lit(width)))
    lookup = rows.select("token", F.explode(F.array("bucket", F.col("bucket") - 1)).alias("bucket"), F.col("id").alias("x"),
                         F.col("size").alias("nx"), F.col("place").alias("i"))
    index = rows.filter("indexed").select("token", "bucket", F.col("id").alias("y"), F.col("size").alias("ny"),
                                          F.col("place").alias("j"))
    if largest is None:
        largest = prefixes.agg(F.max("count").alias("n")).first()["n"] or 0
    met = salted_join(lookup, index, ["token", "bucket"], largest).filter(
        ((F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") > F.col("y"))))
        & (F.col("ny") >= F.lit(t) * F.col("nx") - F.lit(_EPS)))
    pairs = met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m"), F.max("i").alias("i"), F.max("j").alias("j"),
                                      F.max("nx").alias("nx"), F.max("ny").alias("ny"))
    pairs = pairs.filter(F.col("m") + F.least(F.col("nx") - F.col("i") - 1, F.col("ny") - F.col("j") - 1) >= _least_overlap(t))
    counts = prefixes.filter("token is null")
    pairs = (pairs.join(counts.select(F.col("id").alias("x"), F.col("histogram").alias("hx")), "x")
             .join(counts.select(F.col("id").alias("y"), F.col("histogram").alias("hy")), "y"))
    bound = F.coalesce(_overlap_bound("hx", "hy").cast("long"), F.lit(1 << 62))
    return (pairs.filter(bound >= _least_overlap(t))
            .select(F.least("x", "y").alias("first"), F.greatest("x", "y").alias("second")))


def exact_similar_pairs(sets: DataFrame, threshold: float, id_col: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``(first, second, similarity)`` for every pair of sets with Jaccard >= ``threshold``, stored."""
    prefixes = materialize(prefix_tokens(sets, threshold, id_col, width=width), "prefix_tokens", {"largest": F.max("count")})
    pairs = exact_candidate_pairs(prefixes, threshold, int(prefixes._tessera_metrics["largest"] or 0))
    return _verified(pairs, threshold, lambda p: pair_similarity(p, sets, id_col), prefixes)


def _mixed(v: np.ndarray) -> np.ndarray:
    """64-bit values with every bit spread over all (the finalizer of splitmix64)."""
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def size_class_width(threshold: float) -> float:
    """Logarithm of the ratio of a size class; similar sets lie in one class or in two neighbouring ones."""
    return max(math.log(1 / threshold) * 1.001, math.log(1.3))


def size_class(n: int, threshold: float) -> int:
    return math.floor(math.log(n) / size_class_width(threshold))


def _upper(at: int, threshold: float) -> int:
    """No size of the class is above it, whatever the rounding."""
    return math.ceil(math.exp((at + 1) * size_class_width(threshold)))


def _cuts(upper: int, threshold: float) -> tuple[int, int, int]:
    """Of sets whose smaller one has ``upper`` tokens at most: parts, those dropped, and how many kept ones similar sets share."""
    differ = math.floor((1 - threshold) / threshold * upper + _EPS)
    spare = (differ + 1) // 2
    common = 1 + spare // 4
    return differ + 1 + spare, spare + 1 - common, common


def kept_parts(tokens: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, bool]]:
    """Hashes of the kept parts of a set among sets of its size class, and (``True``) as the larger one of a pair in the class below."""
    for found, below, _ in counted_parts(tokens, threshold):
        yield found, below


def counted_parts(tokens: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, bool, int]]:
    """The same with the number of kept parts that similar sets of the class share at least."""
    n = tokens.size
    own = size_class(n, threshold)
    hashes = _mixed(tokens.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    high, again = hashes >> np.uint64(32), _mixed(hashes)
    for at in (own, own - 1):
        upper = _upper(at, threshold)
        if at < own and threshold * n - _EPS > upper:
            continue
        parts, dropped, common = _cuts(upper, threshold)
        part = ((high * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        content = np.zeros(parts, np.uint64)
        np.add.at(content, part, again)
        # by tokens, hash and place, in one number; beyond its bits in three
        if parts <= 1 << 20:
            key = np.minimum(np.bincount(part, minlength=parts), 4095).astype(np.uint64) << np.uint64(52)
            key |= content >> np.uint64(12) & np.uint64(((1 << 52) - 1) ^ ((1 << 20) - 1))
            key |= np.arange(parts, dtype=np.uint64)
            order = (np.partition(key, dropped)[dropped:] & np.uint64((1 << 20) - 1)).astype(np.int64)
        else:
            order = np.lexsort((content, np.bincount(part, minlength=parts)))[dropped:]
        # PART_BITS: chance meetings of equal hashes only add to what two sets share
        found = _mixed(content[order] + _mixed(order.astype(np.uint64) + np.uint64((at + 1) << 40)))
        yield (found >> np.uint64(64 - PART_BITS)).astype(np.int64), at < own, common


PART_BITS = 40      # of the hash of a part
PART_ROWS = 2_000_000  # rows of parts in a task
PACKED = 1 << 20    # rows that are packed at a time


def _planes(values: np.ndarray, bytes_: int) -> np.ndarray:
    """The lowest bytes of integers, a row for each place: places that hardly change pack to nothing."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :bytes_].T)


def _joined(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :planes.shape[0]] = planes.T
    return out.view("<i8")[:, 0]


def _packed(ids: pa.Array, part: np.ndarray, size: np.ndarray, tasks: int) -> pa.RecordBatch:
    """``(task, n, rows, ids)``: the rows of every task as two binary values; a task has a range of parts."""
    codec = pa.Codec("zstd", compression_level=1)
    task = ((part.astype(np.uint64) * np.uint64(tasks)) >> np.uint64(PART_BITS)).astype(np.uint16 if tasks <= 1 << 16 else np.uint32)
    order = np.argsort(task, kind="stable")
    task, ids = task[order], ids.take(pa.array(order))
    rows = np.concatenate((_planes(part[order], PART_BITS // 8), _planes(size[order] * 2 ^ (size[order] >> 63), 5)))
    whole = _planes(ids.to_numpy(), 8) if pa.types.is_int64(ids.type) else None  # no id is null
    starts = np.flatnonzero(np.concatenate(([True], np.diff(task) != 0)))
    ends = np.append(starts[1:], order.size)
    names = [whole[:, a:b].tobytes() if whole is not None else pa.record_batch([ids.slice(a, b - a)], names=["id"]).serialize().to_pybytes()
             for a, b in zip(starts.tolist(), ends.tolist())]
    pack = lambda v: codec.compress(v, asbytes=True)
    return pa.RecordBatch.from_arrays([
        pa.array(task[starts].astype(np.int32)), pa.array((ends - starts).astype(np.int32)),
        pa.array([pack(rows[:, a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
        pa.array([len(v).to_bytes(8, "little") + pack(v) for v in names], pa.binary())], names=["task", "n", "rows", "ids"])


def _unpacked(batch: pa.RecordBatch, kind: pa.DataType) -> Iterator[tuple[np.ndarray, np.ndarray | pa.Array]]:
    """Planes of parts and sizes, and of whole numbers as ids, else the ids."""
    codec, width = pa.Codec("zstd"), PART_BITS // 8 + 5
    for n, rows, ids in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
        buffer = codec.decompress(ids[8:], int.from_bytes(ids[:8], "little"))
        yield (np.frombuffer(codec.decompress(rows, width * n), np.uint8).reshape(width, n),
               np.frombuffer(buffer, np.uint8).reshape(8, n) if pa.types.is_int64(kind)
               else pa.ipc.read_record_batch(buffer, pa.schema([("id", kind)])).column(0))


def _cut_parts(threshold: float, k: int, wanted: Bloom, kind: pa.DataType, tasks: int):
    """Kept parts of the texts whose id the filter may hold: ``(id, part, size)``, packed for ``tasks`` tasks.

    The size is negative in the class below.
    """
    weights = np.array(shingle_weights(k), dtype=np.int64)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.holds(batch.column(2).to_numpy(zero_copy_only=False))))
            for ids, texts in pieces(batch.column(0), batch.column(1)):
                rows, found, size = [], [], []
                for i, text in enumerate(texts.to_pylist()):
                    tokens = text_shingle_hashes(text, weights)
                    for parts, below in kept_parts(tokens, threshold) if tokens.size else ():
                        rows.append(np.full(parts.size, i))
                        found.append(parts)
                        size.append(np.full(parts.size, -tokens.size if below else tokens.size))
                if rows:
                    yield ids.cast(kind).take(pa.array(np.concatenate(rows))), np.concatenate(found), np.concatenate(size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        pack = lambda: _packed(pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2)), tasks)
        for rows in cut(batches):
            held.append(rows)
            n += rows[1].size
            if n >= PACKED:
                yield pack()
                held, n = [], 0
        if held:
            yield pack()
    return run


def _shared(kind: pa.DataType, threshold: float):
    """``(id, part, size, least, sets)``: of a task's packed rows those whose part more than one set has.

    Similar sets of a part's class share ``least`` kept parts at least.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [rows for batch in batches for rows in _unpacked(batch, kind)]
        if not found:
            return
        planes = np.concatenate([f[0] for f in found], axis=1)
        part = _joined(planes[:PART_BITS // 8])
        order = np.argsort(part)
        opens = np.flatnonzero(np.concatenate(([True], np.diff(part[order]) != 0)))
        members = np.diff(np.append(opens, part.size))
        sets = np.repeat(members, members)
        order, sets = order[sets > 1], sets[sets > 1]
        part, size = part[order], _joined(planes[PART_BITS // 8:, order])
        size = (size >> 1) ^ -(size & 1)
        if pa.types.is_int64(kind):
            ids = pa.array(_joined(np.concatenate([f[1] for f in found], axis=1)[:, order]))
        else:
            ids = pa.concat_arrays([f[1] for f in found]).take(pa.array(order))
        sizes, where = np.unique(size, return_inverse=True)
        least = np.array([_cuts(_upper(size_class(abs(n), threshold) - (n < 0), threshold), threshold)[2] for n in sizes.tolist()], np.int32)[where]
        for at in range(0, order.size, 1 << 16):
            some = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([ids[some], pa.array(part[some]), pa.array(size[some], pa.int32()), pa.array(least[some], pa.int32()),
                                              pa.array(sets[some], pa.int64())], names=["id", "part", "size", "least", "sets"])
    return run


CROWD = 16  # sets that share a part and are paired there


def _part_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """``(first, second)``: ids that share as many kept parts as similar sets do, and whose sizes allow for the threshold."""
    x = rows.filter("size > 0").select("part", F.col("id").alias("x"), F.col("size").alias("nx"), "least")
    y = rows.select("part", F.col("id").alias("y"), F.col("size").alias("ny"))
    met = x.join(y, "part").filter((((F.col("ny") < 0) & (F.col("x") != F.col("y"))) | (F.col("x") < F.col("y"))) & size_test(threshold, F.col("nx"), F.abs("ny")))
    return (met.groupBy(F.least("x", "y").alias("first"), F.greatest("x", "y").alias("second"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("least").alias("_least")).filter("_n >= _least").select("first", "second"))


def exact_similar_texts(docs: DataFrame, threshold: float, k: int, ids: DataFrame, tokens: int | None = None) -> DataFrame:
    """The same for the k-character shingle sets of the texts of ``ids`` (column ``doc_id``), out of ``(doc_id, text)`` rows.

    Sets are computed where they are used and stored nowhere. Other documents
    are left out by a Bloom filter in the kernels, and exactly once parts are shared. Every id of ``docs`` is there once. ``tokens``, the sum of
    the sets' sizes, tells how many tasks the parts are dealt to.
    """
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    t, spark = float(threshold), docs.sparkSession
    frame = ensure_parallelism(docs.select("doc_id", "text"), "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.xxhash64("doc_id").alias("h"))
    kind = dict(frame.dtypes)["id"]
    # a set of n tokens has less than 2 (1 - t) / t 1.3 n (1 + 1 / 8) rows, and a few
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(3 * (1 - t) / t * (tokens or 0) / PART_ROWS))
    arrow = to_arrow_type(frame.schema["id"].dataType)
    packed = frame.mapInArrow(_cut_parts(t, k, Bloom.of(ids, "doc_id"), arrow, tasks), "task int, n int, rows binary, ids binary")
    shared = packed.repartitionById(tasks, "task").mapInArrow(_shared(arrow, t), f"id {kind}, part long, size int, least int, sets long")
    shared = materialize(shared, "shared_parts", {"largest": F.max("sets")})
    known = lambda df, c: df.join(ids.select(F.col("doc_id").alias(c)), c, "left_semi")
    pairs, whole = _part_pairs(shared.filter(F.col("sets") <= CROWD), t), None
    pairs = known(known(pairs, "first"), "second").select("first", "second")
    if int(shared._tessera_metrics["largest"] or 0) > CROWD:
        crowded = materialize(known(shared.filter(F.col("sets") > CROWD).select("part", "id", F.abs("size").alias("n")), "id")
                              .select("part", "id", "n"), "crowded_parts")
        whole, blocks = whole_cells(crowded, docs, t, k, int(shared._tessera_metrics["largest"]))
        release(crowded)
        of = lambda c: blocks.select(F.col("id").alias(c), F.col("label").alias(f"_l_{c}"))
        # all pairs of a label are compared already
        pairs = (pairs.join(of("first"), "first", "left").join(of("second"), "second", "left")
                 .filter(~F.coalesce(F.col("_l_first") == F.col("_l_second"), F.lit(False))).select("first", "second"))
    pairs = materialize(pairs, "exact_candidates")
    behind: list[DataFrame] = [shared, pairs]
    found = _reaching(text_pair_similarity(pairs, docs, k, behind=behind), t)
    if whole is not None:
        found = found.unionByName(whole).dropDuplicates(["first", "second"])  # cells of two labels hold listed pairs, too
        behind += [whole, blocks]
    out = materialize(found, "exact_pairs")
    out._tessera_metrics["candidates"] = pairs._tessera_rows + (whole._tessera_metrics["compared"] if whole is not None else 0)
    release(*behind)
    return out


def _reaching(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.filter(F.col("similarity") >= F.lit(float(threshold))).select("first", "second", "similarity")


def _verified(pairs: DataFrame, threshold: float, verify: Callable[[DataFrame], DataFrame], index: DataFrame) -> DataFrame:
    pairs = materialize(pairs, "exact_candidates")
    release(index)
    out = materialize(_reaching(verify(pairs), threshold), "exact_pairs")
    out._tessera_metrics["candidates"] = pairs._tessera_rows
    release(pairs)
    return out
