"""Packing documents into fixed-length training sequences by best-fit decreasing.

A document's ids are first cut into full windows; each is a sequence of its
own. What remains (less than a window) is packed: the remainders of a chunk
of the input, longest first, go into the open window with the least room that
still holds them, found in a segment tree indexed by remaining capacity.
A chunk is a run of rows of one input partition with a bounded number of
remainders, so packing is a pass over the input without any shuffle, a task
holds one chunk of ids at most, and a repeated task packs the same way. Each
chunk leaves about one badly filled window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import END_ID, PieceEncoder, default_vocabulary

LENGTH = 1024
CHUNK = 16_384  # remainders packed together: at most CHUNK * LENGTH ids are held, in one array
EMIT = 1024     # sequences in an output batch

_PIECE = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("offset", pa.int64())])
SEQUENCES = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("pieces", pa.list_(_PIECE)),
                       ("ids", pa.binary())])
SEQUENCES_DDL = ("sequence_id long, n_tokens long, pieces array<struct<doc_id:long,start:long,length:long,"
                 "doc_tokens:long,offset:long>>, ids binary")


class OpenWindows:
    """Open windows by remaining capacity; a segment tree says which capacities have any."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()  # capacities 0 .. length
        self.any = bytearray(2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(length + 1)]

    def _mark(self, capacity: int, there: int) -> None:
        node = self.leaves + capacity
        self.any[node] = there
        while node > 1:
            node >>= 1
            both = self.any[2 * node] | self.any[2 * node + 1]
            if self.any[node] == both:
                break
            self.any[node] = both

    def put(self, capacity: int, window: int) -> None:
        if not self.at[capacity]:
            self._mark(capacity, 1)
        self.at[capacity].append(window)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """``(capacity, window)`` with the least capacity of at least ``need``, taken out; None if there is none."""
        node = self.leaves + need
        while not self.any[node]:
            while node & 1:  # a right child: go up until there is a right neighbour
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of its level
                return None
        while node < self.leaves:
            node = 2 * node + (not self.any[2 * node])
        capacity = node - self.leaves
        window = self.at[capacity].pop()
        if not self.at[capacity]:
            self._mark(capacity, 0)
        return capacity, window


def best_fit_decreasing(lengths: list[int], length: int = LENGTH) -> list[list[int]]:
    """Windows as lists of positions in ``lengths``; every length is from 1 to ``length``."""
    windows: list[list[int]] = []
    room = OpenWindows(length)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = room.tightest(lengths[i])
        if found is None:
            found = (length, len(windows))
            windows.append([])
        capacity, window = found
        windows[window].append(i)
        if capacity > lengths[i]:
            room.put(capacity - lengths[i], window)
    return windows


def _pack(batches: Iterable[pa.RecordBatch], encoder: PieceEncoder, length: int, chunk: int) -> Iterator[tuple]:
    """Sequences ``([(doc_id, start, n, doc_tokens, offset)...], ids)`` of one partition."""
    held: list[tuple] = []  # (doc_id, start, doc_tokens, place of its ids in ``store``) of the chunk's remainders
    store, filled = np.empty(chunk * length, "<u4"), 0  # one for all chunks; its memory is taken as it fills

    def packed() -> Iterator[tuple]:
        for window in best_fit_decreasing([total - start for _, start, total, _ in held], length):
            parts, offset = [], 0
            for i in window:
                doc, start, total, _ = held[i]
                parts.append((doc, start, total - start, total, offset))
                offset += total - start
            yield parts, b"".join(store[at:at + total - start] for _, start, total, at in map(held.__getitem__, window))

    for batch in batches:
        row = 0
        for ids, counts in encoder.groups(batch.column(1)):
            docs = batch.column(0).slice(row, len(counts)).to_pylist()
            row += len(counts)
            ids, counts = np.insert(ids, np.cumsum(counts), END_ID), counts + 1
            for doc, total, end in zip(docs, counts.tolist(), np.cumsum(counts).tolist(), strict=True):
                start = total // length * length
                for at in range(0, start, length):
                    yield [(doc, at, length, total, 0)], ids[end - total + at:end - total + at + length].tobytes()
                if start < total:
                    store[filled:filled + total - start] = ids[end - total + start:end]
                    held.append((doc, start, total, filled))
                    filled += total - start
                    if len(held) >= chunk:
                        yield from packed()
                        held.clear()
                        filled = 0
        pa.default_memory_pool().release_unused()  # of the batch's groups
    yield from packed()


def pack_documents(docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH, chunk: int = CHUNK) -> DataFrame:
    """``(sequence_id, n_tokens, pieces, ids)``: sequences of at most ``length`` ids.

    ``pieces`` lists ``(doc_id, start, length, doc_tokens, offset)``; ``ids``
    are the sequence's ids as little-endian unsigned 32-bit integers, not
    padded. A document is its ids and the end id, so null and empty texts are
    one id long. Null and repeated keys are ordinary documents. An empty
    table gives no sequence. Only the key and the text are read. The numbers
    of sequences are unique, not dense (the task's number and a counter).
    """
    path = vocabulary or default_vocabulary()

    def sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            names = [f.name for f in _PIECE]
            return pa.RecordBatch.from_arrays([
                pa.array(range(first, first + len(rows)), pa.int64()),
                pa.array([len(ids) // 4 for _, ids in rows], pa.int64()),
                pa.array([[dict(zip(names, p, strict=True)) for p in parts] for parts, _ in rows], pa.list_(_PIECE)),
                pa.array([ids for _, ids in rows], pa.binary())], schema=SEQUENCES)

        for row in _pack(batches, PieceEncoder.of(path), length, chunk):
            rows.append(row)
            if len(rows) >= EMIT:
                yield batch()
                first += len(rows)
                rows.clear()
        if rows:
            yield batch()

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(sequences, SEQUENCES_DDL)


def piece_rows(sequences: DataFrame) -> DataFrame:
    """A row per piece with its ids as they lie in the sequence, and their CRC."""
    p = F.col("p")
    own = F.substring(F.col("ids"), (4 * p["offset"] + 1).cast("int"), (4 * p["length"]).cast("int"))
    return (sequences.select("sequence_id", "ids", F.explode("pieces").alias("p"))
            .select(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"),
                    F.crc32(own).alias("ids_crc32"), p["doc_tokens"].alias("doc_tokens"), "sequence_id",
                    p["offset"].alias("offset"), own.alias("ids")))


def op3(docs: DataFrame) -> DataFrame:
    return piece_rows(pack_documents(docs)).drop("ids")
