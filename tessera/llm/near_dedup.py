"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles. Equal sets are one class
from the start, so copies cost one row however many they are. Each class gets
``BANDS * ROWS`` minima; only their low ``BITS`` bits are kept, packed into
64-bit words, besides one bucket key per band.

Candidates come from the buckets without writing out their pairs: every
member is compared with the bucket's smallest class (its hub). The packed
signatures estimate the similarity by bit counts, corrected for low bits that
agree by chance; what could reach the threshold is confirmed on the full
sets. Links make components, and a bucket whose members are in one component
is done. The others are looked at once more, in blocks of bounded size: every
class outside the bucket's main component meets all members of other
components whose estimate could reach the threshold, the most similar first,
until it is linked with them or has met them all. A block has the full sets,
so it hands on confirmed links only, one per class and component; a pair is
looked at in the first of the buckets it shares.

With 32 bands of 5 rows a pair at similarity 0.8 shares no bucket with
probability 3e-6, and five standard deviations of the estimate are allowed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.sketches import Bloom
from tessera.sources.storage import materialize, release, row_count

from .common import hidden
from .graph import connected_components
from .shingle_sets import mixed, shingle_set, word_hashes

BANDS, ROWS = 32, 5
BITS = 4                      # low bits kept of each minimum
PER_WORD = 64 // BITS
CELL = 2048                   # members per side of a block
CELL_SHINGLES = 2_000_000     # shingles per side of a block, on average
MEET = 128                    # sets that a class meets at once
_LOW = sum(1 << (BITS * i) for i in range(PER_WORD))

CLASS_DDL = "doc_id long, n_shingles long, cid long, sig array<long>, buckets array<long>"
_CLASS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cid", pa.int64()),
                    ("sig", pa.list_(pa.int64())), ("buckets", pa.list_(pa.int64()))])


def _multipliers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(packed low bits, bucket keys)`` of a non-empty set."""
    with np.errstate(over="ignore"):
        minima = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 512):
            block = shingles[at:at + 512, None] * multipliers
            np.minimum(minima, block.min(axis=0), out=minima)
        minima = mixed(minima)  # a product's low bits depend on few bits of the shingle; spread them first
        low = (minima & np.uint64((1 << BITS) - 1)).reshape(-1, PER_WORD)
        packed = np.bitwise_or.reduce(low << (np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS)), axis=1)
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)
        for r in range(ROWS):
            keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + minima.reshape(BANDS, ROWS)[:, r])
    return packed.view(np.int64), keys.view(np.int64)


def _set_id(s: np.ndarray) -> int:
    """64 bits that stand for the set: the sum of its spread members and its size."""
    with np.errstate(over="ignore"):
        return int(mixed(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True) + np.uint64(len(s)))[0].view(np.int64))


def _signatures(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers()
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                n, cids, sigs, buckets = [], [], [], []
                for words in word_hashes(batch.column(1)):
                    s = shingle_set(words, size)
                    n.append(len(s))
                    if not len(s):
                        cids.append(None), sigs.append(None), buckets.append(None)
                        continue
                    packed, keys = signature(s, multipliers)
                    cids.append(_set_id(s)), sigs.append(packed), buckets.append(keys)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(cids, pa.int64()),
                    pa.array(sigs, pa.list_(pa.int64())), pa.array(buckets, pa.list_(pa.int64()))], schema=_CLASS)
    return run


def _sets(size: int, wanted: Bloom):
    """``(cid, shingles)`` of the texts whose key (hashed, in front) the filter may hold."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.filter(pa.array(wanted.holds(batch.column(0).to_numpy(zero_copy_only=False))))
            for at in range(0, whole.num_rows, 512):
                sets = [shingle_set(w, size) for w in word_hashes(whole.slice(at, 512).column(1))]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([_set_id(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["cid", "shingles"])
    return run


# ---------------------------------------------------------------- estimates

def estimate_cut(percent: int) -> float:
    """The least estimate that still counts as possible: the threshold less five standard deviations."""
    k, c, t = BANDS * ROWS, 2.0 ** -BITS, percent / 100
    p = c + (1 - c) * t
    return t - 5 * (p * (1 - p) / k) ** 0.5 / (1 - c)


def _estimated(differing, total: int):
    """Similarity from the number of differing low-bit groups, corrected for chance agreement."""
    c = 2.0 ** -BITS
    return ((total - differing) / total - c) / (1 - c)


def estimate(a: Column, b: Column) -> Column:
    """The estimate from two packed signatures, by bit counts."""
    parts = []
    for i in range(BANDS * ROWS // PER_WORD):
        x = a[i].bitwiseXOR(b[i])
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        parts.append(F.bit_count(folded.bitwiseAND(F.lit(_LOW))))
    return _estimated(sum(parts[1:], parts[0]), BANDS * ROWS)


def _estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All estimates between two blocks of packed signatures."""
    differing = np.zeros((len(left), len(right)), np.uint16)
    for i in range(left.shape[1]):
        x = left[:, i, None] ^ right[None, :, i]
        folded = x.copy()
        for s in range(1, BITS):
            folded |= x >> np.uint64(s)
        differing += np.bitwise_count(folded & np.uint64(_LOW))
    return _estimated(differing, BANDS * ROWS)


def _rows_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and unsigned values of a list column."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))), lists.flatten().to_numpy().view(np.uint64)


def _met(own: np.ndarray, others: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of one set with several."""
    sizes = offsets[others + 1] - offsets[others]
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(offsets[others] - starts, sizes) + np.arange(sizes.sum())
    v = values[at]
    place = np.minimum(np.searchsorted(own, v), len(own) - 1)
    return np.add.reduceat(own[place] == v, starts, dtype=np.int64)


def _cell_links(cut: float, percent: int):
    """Confirmed links of a block between components, at most one per class and other component."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, i, j = (k.as_py() for k in key)
        cid, comp, sub = (table.column(c).to_numpy() for c in ("cid", "comp", "sub"))
        sig = _rows_of(table.column("sig"))[1].reshape(len(cid), -1)
        buckets = _rows_of(table.column("buckets"))[1].reshape(len(cid), -1)
        offsets, values = _rows_of(table.column("shingles"))
        here = np.array([bucket], np.int64).view(np.uint64)[0]
        names, counts = np.unique(comp, return_counts=True)
        outside = comp != names[counts.argmax()]
        links = []
        order = np.flatnonzero(outside)
        for at in range(0, len(order), 64):
            mine = order[at:at + 64]
            estimates = _estimates(sig[mine], sig)
            for x, e in zip(mine, estimates, strict=True):
                meets = (e >= cut) & (comp != comp[x]) & (~outside | (np.arange(len(cid)) > x))
                if i != j:
                    meets &= sub != sub[x]
                found = np.flatnonzero(meets)
                first = (buckets[found] == buckets[x]).argmax(axis=1)
                found = found[buckets[x][first] == here]
                found = found[np.argsort(-e[found], kind="stable")]
                own = values[offsets[x]:offsets[x + 1]]
                while len(found):
                    now, found = found[:MEET], found[MEET:]
                    both = _met(own, now, offsets, values)
                    fine = 100 * both >= percent * (len(own) + offsets[now + 1] - offsets[now] - both)
                    linked, places = np.unique(comp[now[fine]], return_index=True)
                    links += [(cid[x], cid[y]) for y in now[fine][places]]
                    found = found[~np.isin(comp[found], linked)]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})
    return run


def _open_cells(crowded: DataFrame, comps: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components, dealt into blocks ``(bucket, i, j)`` with their sets."""
    members = (crowded.filter("cid <> hub")  # the hub has met everybody
               .join(comps, crowded["cid"] == comps["node"], "left")
               .select("bucket", "cid", "n", F.coalesce("comp", "cid").alias("comp")))
    blocks = F.ceil(F.greatest(F.col("m") / CELL, F.col("n") / CELL_SHINGLES)).cast("int")
    unsettled = (members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"),
                                               F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .filter("lo <> hi").select("bucket", blocks.alias("blocks")))
    dealt = (members.drop("n").join(unsettled, "bucket")
             .withColumn("sub", F.pmod(F.xxhash64("cid"), F.col("blocks").cast("long")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", "cid", "comp", "sub", F.least("sub", "other").alias("i"), F.greatest("sub", "other").alias("j")))
    return dealt.join(classes.select("cid", "sig", "buckets"), "cid").join(sets, "cid")


# ---------------------------------------------------------------- the operator

def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold. The hub's set joins last, so it isn't shuffled with every pair."""
    second = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b"))
    first = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(second, "b").join(first, "a")
            .select("a", "b", both.cast("long").alias("both"),
                    (F.size("set_a") + F.size("set_b")).cast("long").alias("sum"))
            .filter(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(key, n_shingles, component_id, kept)``, one row per row of ``docs``.

    ``n_shingles`` is the size of the document's set, ``component_id`` the
    smallest key reachable over links of at least ``percent`` per cent,
    ``kept`` whether it is the document's own. Null, empty and blank texts
    have no set and link with nothing. Texts of fewer words than a shingle
    have one. Rows that repeat a key are rows of their own with the same
    name. A null key takes part by its text, but names no component; it is
    kept only if its component has no other name. An empty table gives no
    rows; further columns are not read.
    """
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialize(own.mapInArrow(_signatures(shingle), CLASS_DDL), "near-signed")
    # copies meet here, before anything is compared
    classes = materialize(signed.filter("cid is not null").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("buckets").alias("buckets")), "near-classes")

    member = classes.select("cid", "n", F.explode("buckets").alias("bucket"))
    hubs = (member.groupBy("bucket").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("m"))
            .filter("m > 1").select("bucket", "hub"))
    crowded = materialize(member.join(hubs, "bucket"), "near-crowded")

    # one document of each class in a shared bucket gives its set; the others are left out in the scan
    involved = materialize(crowded.select("cid").distinct().join(classes.select("cid", "rep"), "cid").select("rep").distinct(),
                           "near-involved")
    sets = own.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(
        _sets(shingle, Bloom.of(involved, "rep")), "cid long, shingles array<long>")
    sets = materialize(sets.join(crowded.select("cid").distinct(), "cid", "left_semi").dropDuplicates(["cid"]), "near-sets")

    cut = estimate_cut(percent)
    sig = classes.select("cid", "sig")
    starred = crowded.filter("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    starred = (starred.join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("sig_b")), "b")
               .join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("sig_a")), "a")
               .filter(estimate(F.col("sig_a"), F.col("sig_b")) >= cut).select("a", "b"))
    links = materialize(_confirmed(starred, sets, percent), "near-links")
    comps = materialize(connected_components(links), "near-components")
    found = [comps]

    cells = _open_cells(crowded, comps, classes, sets)
    more = materialize(cells.groupBy("bucket", "i", "j").applyInArrow(_cell_links(cut, percent), "a long, b long")
                       .distinct(), "near-links")
    if row_count(more):
        comps = materialize(connected_components(links.unionByName(more)), "near-components")
        found.append(comps)

    named = (classes.select("cid", "rep").join(comps, F.col("cid") == F.col("node"), "left")
             .select("cid", "rep", F.coalesce("comp", "cid").alias("comp")))
    names = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = materialize(named.select("cid", "comp").join(names, "comp").select(F.col("cid").alias("class"), "component_id"),
                        "near-named")
    rows = materialize(signed.select("doc_id", "n_shingles", "cid"), "near-rows")
    release(signed, classes, crowded, involved, sets, links, more, *found)
    out = (rows.join(named, F.col("cid") == F.col("class"), "left")
           .withColumn("component_id", F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))))
    return out.select(F.col("doc_id").alias(key), "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                         percent: int = 80) -> DataFrame:
    """One document of each component, with the columns of ``docs``: the one that names it.

    Rows that repeat a key are one document: it goes only if none of its rows
    is kept, and one row of it stays. Rows without a key are documents of
    their own, numbered behind all keys (in front of them, where they would
    leave 64 bits), so of a component that no key names one row stays. A
    Bloom filter of the keys that go picks the rows to look at; the others
    pass without a shuffle.
    """
    if not docs.filter(docs[key].isNull()).limit(1).count():
        return _dropped(docs, key, text, shingle, percent)
    number = hidden(docs, stem="number")
    ends = docs.agg(F.min(F.col(key).cast("long")).alias("low"), F.max(F.col(key).cast("long")).alias("high")).first()
    place = F.monotonically_increasing_id() + 1
    behind = (ends["high"] or 0) < 1 << 62
    free = F.lit(ends["high"] or 0) + place if behind else F.lit(ends["low"]) - place
    numbered = materialize(docs.withColumn(number, F.coalesce(docs[key].cast("long"), free)), "near-numbered")
    return _dropped(numbered, number, text, shingle, percent).select(*[F.col(f"`{c}`") for c in docs.columns])


def _dropped(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    mine = hidden(docs, stem="key")
    found = near_duplicates(docs, key, text, shingle, percent)
    per_key = materialize(found.groupBy(F.col(key).alias(mine))
                          .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "near-keys",
                          {"repeated": F.count_if(F.col("kept") & (F.col("n") > 1))})
    left = _without(docs, key, per_key.filter(~F.col("kept")).select(mine), mine)
    if not per_key._tessera_metrics["repeated"]:
        return left
    repeated = per_key.filter(F.col("kept") & (F.col("n") > 1)).select(mine)
    same_key = left[key].cast("long") == F.col(mine)
    return (left.join(repeated, same_key, "left_anti")
            .unionByName(left.join(repeated, same_key, "left_semi").dropDuplicates([key])))


def _without(docs: DataFrame, key: str, going: DataFrame, mine: str) -> DataFrame:
    """``docs`` less the rows whose key is in ``going`` (one column ``mine``)."""
    may_go = Bloom.of(going, mine).may_hold(docs[key].cast("long"))
    looked_at = docs.filter(may_go)
    return docs.filter(~may_go).unionByName(looked_at.join(going, looked_at[key].cast("long") == F.col(mine), "left_anti"))


def op1(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, shingle=2)
