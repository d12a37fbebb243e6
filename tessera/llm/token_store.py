"""Token ids in files with a minimal perfect hash index for keyed access.

Store layout, all written by Spark below one folder:

* ``payload``: blocks of raw ids (little-endian unsigned 32-bit) of
  consecutive documents in ascending key order, with the block's directory;
* ``blocks``: the global place of every block's first id;
* ``index``: per hash shard of the keys one minimal perfect hash function
  and, in the order of its slots, a 32-bit fingerprint and the place of the
  document (part, block, offset, number of ids).

The function of a shard is a cascade of bit arrays: a key whose bit at a
level is its own sets it, the others go on to the next level; the slot of a
key is the number of set bits before its own. A lookup is one shard row, a
few bits, one rank and one fingerprint, whatever the size of the store. Keys
that no level can separate (equal 64-bit hashes) are kept in a list.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.storage import checkpoint_root

from .tokens import END_ID, PieceEncoder, default_vocabulary

BLOCK_IDS = 1 << 18     # ids after which a block is closed (1 MB)
INDEX_KEYS = 16_384     # keys of an index shard, on average
GAMMA = 2               # bits per key still unplaced at a level
LEVELS = 48

_RECORD = pa.struct([("doc_id", pa.int64()), ("copy", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
_BLOCKS = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n_tokens", pa.int64()),
                     ("records", pa.list_(_RECORD)), ("payload", pa.binary())])
_BLOCKS_DDL = ("part long, block long, n_tokens long, "
               "records array<struct<doc_id:long,copy:long,offset:long,n_tokens:long>>, payload binary")
_INDEX_DDL = ("shard long, n_keys long, level_bits array<long>, bits binary, ranks binary, fingerprints binary, "
              "places binary, loose array<struct<doc_id:long,copy:long,slot:long>>")
_PLACES = ["part", "block", "offset", "n_tokens"]


# ---------------------------------------------------------------- keys and the hash function

def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A seeded bijection of 64-bit integers."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hashes(doc_ids: pd.Series, copies: pd.Series) -> np.ndarray:
    """64 bits per ``(doc_id, copy)``; a null id has a hash of its own."""
    null = doc_ids.isna().to_numpy()
    ids = doc_ids.fillna(0).astype("int64").to_numpy().view(np.uint64)
    with np.errstate(over="ignore"):
        return _mixed(ids ^ _mixed(copies.astype("int64").to_numpy().view(np.uint64), 1) ^ null.astype(np.uint64), 2)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mixed(hashes, 3) >> np.uint64(32)).astype("<u4")


def build_function(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """``(bits per level, all bits, slots)``; slot -1 for keys that share their hash with another."""
    sizes, levels = [], []
    slots = np.full(len(hashes), -1, np.int64)
    left, before = np.arange(len(hashes)), 0
    while len(left) and len(sizes) < LEVELS:
        m = GAMMA * len(left) + 64
        with np.errstate(over="ignore"):
            at = (_mixed(hashes[left], 16 + len(sizes)) % np.uint64(m)).astype(np.int64)
        own = np.bincount(at, minlength=m) == 1
        placed = own[at]
        slots[left[placed]] = before + (np.cumsum(own) - 1)[at[placed]]
        before += int(own.sum())
        sizes.append(m)
        levels.append(own)
        left = left[~placed]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool), slots


def find_slots(sizes: list[int], bits: np.ndarray, ranks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The slot of every hash; -1 if no level has its bit. ``ranks``: set bits before each bit."""
    slots = np.full(len(hashes), -1, np.int64)
    left, start = np.arange(len(hashes)), 0
    for level, m in enumerate(sizes):
        if not len(left):
            break
        with np.errstate(over="ignore"):
            at = start + (_mixed(hashes[left], 16 + level) % np.uint64(m)).astype(np.int64)
        hit = bits[at]
        slots[left[hit]] = ranks[at[hit]]
        left, start = left[~hit], start + m
    return slots


# ---------------------------------------------------------------- writing

def _copies(keys: pa.Array, before: tuple | None) -> tuple[np.ndarray, tuple]:
    """How many rows with its key come before each row, and the last key with its number; ``before`` is that of the rows before."""
    null, ids = keys.is_null().to_numpy(zero_copy_only=False), keys.fill_null(0).to_numpy()
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
    lengths = np.diff(np.append(first, len(ids)))
    copies = np.arange(len(ids)) - np.repeat(first, lengths)
    if before is not None and before[:2] == (null[0], ids[0]):
        copies[:lengths[0]] += before[2] + 1
    return copies, (null[-1], ids[-1], copies[-1])


def _blocks(batches: Iterable[pa.RecordBatch], path: str, block_ids: int) -> Iterator[pa.RecordBatch]:
    encoder, part = PieceEncoder.of(path), TaskContext.get().partitionId()
    block, offset, last = 0, 0, None
    held: list[tuple[pa.Array, np.ndarray]] = []  # records and ids of the open block

    def closed() -> pa.RecordBatch:
        records = pa.concat_arrays([r for r, _ in held])
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([offset], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records),
            pa.array([b"".join(ids for _, ids in held)], pa.binary())], schema=_BLOCKS)

    for batch in batches:
        if not batch.num_rows:
            continue
        copies, last = _copies(batch.column(0), last)
        row = 0
        for ids, counts in encoder.groups(batch.column(1)):
            ids, counts = np.insert(ids, np.cumsum(counts), END_ID), counts + 1
            ends, at = np.cumsum(counts), 0
            while at < len(counts):
                begun = ends[at] - counts[at]
                # the block ends with the document that fills it
                to = min(int(np.searchsorted(ends, begun + block_ids - offset)) + 1, len(counts))
                places = offset + ends[at:to] - counts[at:to] - begun
                held.append((pa.StructArray.from_arrays(
                    [batch.column(0).slice(row + at, to - at), pa.array(copies[row + at:row + to], pa.int64()),
                     pa.array(places, pa.int64()), pa.array(counts[at:to], pa.int64())], fields=list(_RECORD)),
                    ids[begun:ends[to - 1]]))
                offset += int(ends[to - 1] - begun)
                at = to
                if offset >= block_ids:
                    yield closed()
                    block, offset = block + 1, 0
                    held.clear()
            row += len(counts)
    if held:
        yield closed()


def _index_shard(rows: pd.DataFrame) -> pd.DataFrame:
    h = key_hashes(rows["doc_id"], rows["copy"])
    sizes, bits, slots = build_function(h)
    n = int((slots >= 0).sum())
    loose = np.flatnonzero(slots < 0)
    slots[loose] = n + np.arange(len(loose))
    order = np.argsort(slots)
    ranks = np.cumsum(bits, dtype=np.int64) - bits
    return pd.DataFrame([{
        "shard": rows["shard"].iloc[0], "n_keys": len(rows), "level_bits": sizes,
        "bits": np.packbits(bits).tobytes(), "ranks": ranks[::512].astype("<i8").tobytes(),
        "fingerprints": fingerprints(h)[order].tobytes(),
        "places": rows[_PLACES].to_numpy(dtype="<i8")[order].tobytes(),
        "loose": [{"doc_id": None if pd.isna(rows["doc_id"].iloc[i]) else int(rows["doc_id"].iloc[i]),
                   "copy": int(rows["copy"].iloc[i]), "slot": int(slots[i])} for i in loose]}])


def _shard_of(shards: int):
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(shards))


def write_store(docs: DataFrame, folder: str, vocabulary: str | None = None, key: str = "doc_id", text: str = "text",
                block_ids: int = BLOCK_IDS, index_keys: int = INDEX_KEYS) -> str:
    """Encode ``docs`` and write the three tables below ``folder``.

    A document is its ids and the end id (null and empty texts: the end id
    alone). Null keys come first. Rows that repeat a key follow each other by
    the CRC of their texts and are told apart by ``copy`` (0, 1, ...). An
    empty table gives an empty store. Further columns are not read.
    """
    spark = docs.sparkSession
    path = vocabulary or default_vocabulary()
    ordered = (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.crc32("text")))
    (ordered.mapInArrow(lambda batches: _blocks(batches, path, block_ids), _BLOCKS_DDL)
     .write.option("compression", "zstd").parquet(f"{folder}/payload"))

    payload = spark.read.schema(_BLOCKS_DDL).parquet(f"{folder}/payload")
    sizes = payload.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per task that wrote
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    (sizes.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
     .join(parts, "part").select("part", "block", "n_tokens", (F.col("part_start") + F.col("in_part")).alias("start"))
     .write.parquet(f"{folder}/blocks"))

    records = payload.select("part", "block", F.explode("records").alias("r")).select("part", "block", "r.*")
    n_docs = payload.select(F.sum(F.size("records"))).first()[0] or 0
    shards = max(1, -(-n_docs // index_keys))
    (records.withColumn("shard", _shard_of(shards)).withColumn("shards", F.lit(shards))
     .groupBy("shard").applyInPandas(_index_shard, _INDEX_DDL)
     .withColumn("shards", F.lit(shards)).write.parquet(f"{folder}/index"))
    return folder


# ---------------------------------------------------------------- reading

def _looked_up(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = keys[["doc_id", "copy"]].copy()
    places = np.full((len(keys), 4), -1, np.int64)
    if len(index) and len(keys):
        row = index.iloc[0]
        sizes = [int(x) for x in row["level_bits"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        stored = np.frombuffer(row["ranks"], "<i8")
        inner = np.cumsum(np.pad(bits, (0, -len(bits) % 512)).reshape(-1, 512), axis=1).reshape(-1)[:len(bits)] - bits
        ranks = np.repeat(stored, 512)[:len(bits)] + inner
        h = key_hashes(keys["doc_id"], keys["copy"])
        slots = find_slots(sizes, bits, ranks, h)
        prints = np.frombuffer(row["fingerprints"], "<u4")
        loose = {(x["doc_id"], x["copy"]): x["slot"] for x in row["loose"]}
        if loose:
            for i, (d, c) in enumerate(zip(keys["doc_id"], keys["copy"], strict=True)):
                slots[i] = loose.get((None if pd.isna(d) else int(d), int(c)), slots[i])
        known = slots >= 0
        known[known] = prints[slots[known]] == fingerprints(h[known])
        places[known] = np.frombuffer(row["places"], "<i8").reshape(-1, 4)[slots[known]]
    for i, name in enumerate(_PLACES):
        out[name] = places[:, i]
    return out[out["part"] >= 0]


def locate(keys: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, copy, part, block, offset, n_tokens)`` of the ``(doc_id, copy)`` rows that the store has.

    Keys and index shards meet by shard; a key that isn't stored is dropped
    unless its fingerprint collides (one in 2^32).
    """
    index = keys.sparkSession.read.schema(_INDEX_DDL + ", shards long").parquet(f"{folder}/index")
    top = index.agg(F.max("shards").alias("n")).first()["n"] or 1
    keys = keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long")).withColumn("shard", _shard_of(top))
    return keys.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        _looked_up, "doc_id long, copy long, part long, block long, offset long, n_tokens long")


def get_ids(keys: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, copy, ids)`` for a set of keys: their places, then the blocks that hold them."""
    payload = keys.sparkSession.read.schema(_BLOCKS_DDL).parquet(f"{folder}/payload").select("part", "block", "payload")
    at = F.substring("payload", (4 * F.col("offset") + 1).cast("int"), (4 * F.col("n_tokens")).cast("int"))
    return locate(keys, folder).join(payload, ["part", "block"]).select("doc_id", "copy", at.alias("ids"))


def _crcs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, block, starts, payload in zip(*[c.to_pylist() for c in batch.columns[:3]], batch.column(3), strict=True):
            raw = memoryview(payload.as_buffer())
            ends = [*starts[1:], len(raw) // 4]
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(starts), pa.int64()), pa.array([block] * len(starts), pa.int64()),
                pa.array(starts, pa.int64()), pa.array([e - s for s, e in zip(starts, ends, strict=True)], pa.int64()),
                pa.array([zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts, ends, strict=True)], pa.int64())],
                names=["part", "block", "offset", "n_tokens", "ids_crc32"])


def read_digest(keys: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, copy, start, n_tokens, ids_crc32)`` of the keys, read back from the files.

    The index gives every key its place. The payload is read once where it
    lies: a block's documents are summed up beside it and only those sums
    meet the places, so no payload is shuffled.
    """
    spark = keys.sparkSession
    payload = spark.read.schema(_BLOCKS_DDL).parquet(f"{folder}/payload")
    sums = payload.select("part", "block", F.col("records.offset").alias("starts"), "payload").mapInArrow(
        _crcs, "part long, block long, offset long, n_tokens long, ids_crc32 long")
    starts = spark.read.schema("part long, block long, n_tokens long, start long").parquet(f"{folder}/blocks")
    return (locate(keys, folder).join(sums, ["part", "block", "offset", "n_tokens"])
            .join(starts.select("part", "block", F.col("start").alias("block_start")), ["part", "block"])
            .select("doc_id", "copy", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def store_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tessera/token-store-{uuid.uuid4().hex}"


def op2(docs: DataFrame) -> DataFrame:
    folder = write_store(docs, store_folder(docs.sparkSession))
    keys = (docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")))
    return read_digest(keys, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
