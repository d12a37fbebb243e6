"""Hash kernels for shingling and MinHash.

The kernels are iterator UDFs over Arrow batches with numpy inner loops: Spark
partitions the documents and ships column batches; Python works on a piece of
``PIECE`` bytes of a batch at a time and hands its rows on, so that a worker
holds one batch of texts and the sets of one piece, whatever the table's size.
Everything else in the similarity job is built-in Spark expressions, joins and
aggregations.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Shingle hash: a k-character shingle with Unicode code points c_0 .. c_{k-1}
# hashes to (sum_j c_j * SHINGLE_BASE^(k-1-j)) mod SHINGLE_PRIME, a 32-bit value.
SHINGLE_PRIME = 4294967291            # largest prime below 2^32
SHINGLE_BASE = 1000003
# MinHash family: h_i(x) = ((a_i * x + b_i) mod MINHASH_PRIME) mod MINHASH_RANGE,
# with 1 <= a_i <= 2^31 - 2 and 0 <= b_i <= 2^32 - 1 so that a_i * x + b_i < 2^63.
MINHASH_PRIME = 2305843009213693951   # 2^61 - 1
MINHASH_RANGE = 4294967296            # 2^32
A_MAX = 2 ** 31 - 2
B_MAX = 2 ** 32 - 1
# ------------------------------------------------------------------------------

# The UDF kernels below are shipped to the Python workers by value, so the
# executors do not need this package installed.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

_CHUNK = 256  # shingles per numpy block in the MinHash kernel (143 x 256 int64 ~ 290 kB)
_WIDTH = 768  # the same for 32-bit products (143 x 768 uint32 ~ 440 kB, three such blocks a worker)
PIECE = 1 << 20  # bytes of texts, or of arrays, whose results a kernel holds at a time


def shingle_weights(k: int) -> list[int]:
    """``SHINGLE_BASE^(k-1-j) mod SHINGLE_PRIME`` for j = 0..k-1."""
    if not 1 <= k <= 1024:
        raise ValueError("shingle size must be in [1, 1024]")  # keeps the weighted sum < 2^63
    return [pow(SHINGLE_BASE, k - 1 - j, SHINGLE_PRIME) for j in range(k)]


def text_shingle_hashes(text: str, weights: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of every k-character window of ``text``."""
    k = weights.size
    cp = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    n = cp.size - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    acc = cp[0:n] * weights[0]
    for j in range(1, k):
        acc += cp[j:j + n] * weights[j]
    acc %= SHINGLE_PRIME
    acc.sort()
    keep = np.empty(n, dtype=bool)        # sorted distinct (cheaper than np.unique here)
    keep[0] = True
    np.not_equal(acc[1:], acc[:-1], out=keep[1:])
    return acc[keep]


def pieces(*columns: pa.Array, most: int = PIECE) -> Iterator[tuple[pa.Array, ...]]:
    """Rows of the columns in runs of about ``most`` bytes, a row at least."""
    rows = len(columns[0])
    if not rows:
        return
    step = max(1, rows * most // max(1, sum(c.nbytes for c in columns)))
    at = 0
    while at < rows:
        n = min(step, rows - at)
        while n > 1 and sum(c.slice(at, n).nbytes for c in columns) > 2 * most:  # long rows come together
            n = (n + 1) // 2
        yield tuple(c.slice(at, n) for c in columns)
        at += n


def list_array(values: list[np.ndarray | None]) -> pa.ListArray:
    """``array<bigint>`` of numpy arrays; ``None`` is null."""
    held = [v for v in values if v is not None]
    ends = np.cumsum([0, *(0 if v is None else v.size for v in values)])
    if ends[-1] >= 1 << 31:
        raise ValueError("more than 2^31 elements in a batch")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*held, np.empty(0, np.int64)]), pa.int64()),
                                    mask=pa.array([v is None for v in values], pa.bool_()))


def shingle_hashes(text: Column, k: int) -> Column:
    """``array<bigint>``: sorted distinct hashes of the k-character shingles of ``text``.

    Characters are Unicode code points (accents and emoji count as one). Texts
    shorter than ``k`` give an empty array; null gives null.
    """
    weights = np.array(shingle_weights(k), dtype=np.int64)

    @F.arrow_udf(T.ArrayType(T.LongType(), containsNull=False))
    def _shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (texts,) in pieces(batch):
                yield list_array([None if t is None else text_shingle_hashes(t, weights) for t in texts.to_pylist()])

    return _shingles(text)


def hash_family(n: int, seed: int = 1) -> list[tuple[int, int]]:
    """``n`` distinct MinHash parameter pairs ``(a, b)`` drawn from ``random.Random(seed)``.

    Index order is the draw order, so signatures are reproducible from the
    seed alone.
    """
    rng = random.Random(seed)
    seen: set[tuple[int, int]] = set()
    params: list[tuple[int, int]] = []
    while len(params) < n:
        ab = (rng.randint(1, A_MAX), rng.randint(0, B_MAX))
        if ab not in seen:
            seen.add(ab)
            params.append(ab)
    return params


def _reduced(v: np.ndarray) -> np.ndarray:
    """``(v mod p) mod 2^32`` of int64 values, in place where it can."""
    p = np.int64(MINHASH_PRIME)
    high = v >> 61
    v &= p
    v += high
    if (v >= p).any():
        v[...] = np.where(v >= p, v - p, v)
    v &= np.int64(MINHASH_RANGE - 1)
    return v


def _minhash_wide(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The values of :func:`minhash_kernel` in 64-bit arithmetic throughout."""
    sig = np.full(a.size, MINHASH_RANGE, dtype=np.int64)
    for start in range(0, x.size, _CHUNK):
        v = a[:, None] * x[None, start:start + _CHUNK]      # a x + b < 2^63: no overflow
        v += b[:, None]
        np.minimum(sig, _reduced(v).min(axis=1), out=sig)
    return sig


def minhash_kernel(a: np.ndarray, b: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """``x -> min_x ((a x + b) mod p) mod 2^32`` per function, ``x`` being one document's distinct shingles.

    With v = a x + b < 2^63, v mod p is ``(v & p) + (v >> 61)``, less p in the
    rarest cases, so its low 32 bits are those of v plus c, c from 0 to 3. The
    low bits of v come from 32-bit products; as c is not known, ``u`` is kept
    three higher: unless ``u < 3`` the value lies in ``[u - 3, u]``. Only
    shingles within 3 of the least ``u`` can have the least value, hardly ever
    more than one, and theirs are computed in full; functions with some
    ``u < 3`` are computed in full for all shingles.
    """
    wide: list[np.ndarray] = []

    def block(x: np.ndarray) -> np.ndarray:
        if x.size < 128 or int(x.min()) < 0 or int(x.max()) >= MINHASH_RANGE:
            return _minhash_wide(x, a, b)
        if not wide:  # whole rows of a factor are multiplied faster than one factor is spread
            rows = lambda v: np.repeat(v.astype(np.uint32)[:, None], _WIDTH, axis=1)
            wide.extend((rows(a), rows(b + 3), np.empty((a.size, _WIDTH), np.uint32)))
        factor, summand, out = wide
        low, three, all_rows = x.astype(np.uint32), np.uint32(3), np.arange(a.size)
        sig = np.full(a.size, MINHASH_RANGE, dtype=np.int64)
        best = np.full(a.size, MINHASH_RANGE - 4, dtype=np.uint32)  # so that best + 3 fits
        whole = np.zeros(a.size, dtype=bool)
        near: list[tuple[np.ndarray, np.ndarray]] = []
        for start in range(0, x.size, _WIDTH):
            xs = low[start:start + _WIDTH]
            u = out[:, :xs.size]
            np.multiply(factor[:, :xs.size], xs, out=u)
            u += summand[:, :xs.size]
            at = u.argmin(axis=1)
            least = u[all_rows, at]
            whole |= least < three
            rows = np.flatnonzero(least <= best + three)
            if not rows.size:
                continue
            np.minimum(best, least, out=best)
            u[all_rows, at] = MINHASH_RANGE - 1
            again = rows[u.min(axis=1)[rows] <= best[rows] + three]  # more than its least: hardly ever
            near.append((rows, at[rows] + start))
            if again.size:
                more, there = np.nonzero(u[again] <= (best[again] + three)[:, None])
                near.append((again[more], there + start))
        rows, at = (np.concatenate(v) for v in zip(*near))
        np.minimum.at(sig, rows, _reduced(a[rows] * x[at] + b[rows]))
        for row in np.flatnonzero(whole):
            sig[row] = _minhash_wide(x, a[row:row + 1], b[row:row + 1])[0]
        return sig

    return block


def minhash_block(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise ``min_x ((a x + b) mod p) mod 2^32`` over one document's shingles ``x``."""
    return minhash_kernel(a, b)(x)


def minhash_signature(shingles: Column, params: list[tuple[int, int]]) -> Column:
    """``array<bigint>`` of length ``len(params)``: the MinHash signature of a shingle set.

    Empty or null sets give null.
    """
    a = np.array([p[0] for p in params], dtype=np.int64)
    b = np.array([p[1] for p in params], dtype=np.int64)

    @F.arrow_udf(T.ArrayType(T.LongType(), containsNull=False))
    def _minhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signature = minhash_kernel(a, b)
        for batch in batches:
            for (sets,) in pieces(batch):
                rows = (x.values if x.is_valid else None for x in sets)
                yield list_array([None if x is None or len(x) == 0 else
                                  signature(x.to_numpy(zero_copy_only=False).astype(np.int64)) for x in rows])

    return _minhash(shingles)


def shingles_with_signature(text: Column, k: int, params: list[tuple[int, int]]) -> Column:
    """``struct<shingles, signature>`` from one pass over each text.

    Same values as :func:`shingle_hashes` and :func:`minhash_signature`, but
    the shingle arrays cross the JVM/Python boundary only once.
    """
    weights = np.array(shingle_weights(k), dtype=np.int64)
    a = np.array([p[0] for p in params], dtype=np.int64)
    b = np.array([p[1] for p in params], dtype=np.int64)
    schema = T.StructType([
        T.StructField("shingles", T.ArrayType(T.LongType(), containsNull=False)),
        T.StructField("signature", T.ArrayType(T.LongType(), containsNull=False)),
    ])

    @F.arrow_udf(schema)
    def _both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signature = minhash_kernel(a, b)
        for batch in batches:
            for (texts,) in pieces(batch):
                sets = [None if t is None else text_shingle_hashes(t, weights) for t in texts.to_pylist()]
                sigs = [None if x is None or x.size == 0 else signature(x) for x in sets]
                yield pa.StructArray.from_arrays([list_array(sets), list_array(sigs)], names=["shingles", "signature"])

    return _both(text)


def text_similarity(first: Column, second: Column, k: int) -> Column:
    """Exact Jaccard (double) of the k-character shingle sets of two texts.

    Both sets are computed where the texts meet and never leave the kernel;
    the sets of the last few texts are kept, since rows come in runs of one text.
    """
    weights = np.array(shingle_weights(k), dtype=np.int64)

    @F.arrow_udf(T.DoubleType())
    def _similarity(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held: dict[str, np.ndarray] = {}

        def tokens(text: str) -> np.ndarray:
            if text not in held:
                while len(held) >= 8:
                    held.pop(next(iter(held)))
                held[text] = text_shingle_hashes(text, weights)
            return held[text]

        for batch in batches:
            for a, b in pieces(*batch):
                out = np.empty(len(a))
                for i, (s, t) in enumerate(zip(a.to_pylist(), b.to_pylist())):
                    x, y = tokens(s), tokens(t)
                    both = np.concatenate((x, y))
                    both.sort(kind="stable")  # two sorted runs: one merge
                    common = int((both[1:] == both[:-1]).sum())
                    out[i] = common / (both.size - common)
                yield pa.array(out)

    return _similarity(first, second)
