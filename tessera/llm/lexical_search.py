"""Ranked lexical search of many items at once, with common subexpressions shared among the items.

The score of a document for an item is a sum over the item's terms, so items
that share terms share parts of that sum. Per block of items:

1. *Mining.* Terms held by the same items equally often are one atom. The
   atoms of every item are put in one order (those of most items first), and
   neighbours that stand together in several items are joined to a node, round
   after round, until no pair of neighbours repeats. What is left of an item is
   a short list of nodes: a query-sharing graph in which every node is the sum
   of two earlier ones.
2. *Counting.* One pass over the texts stores, per document, its length and
   how often it holds the block's terms; document frequencies, the number of
   documents and their total length come from that narrow table.
3. *Scoring.* Over blocks of documents, the atoms' accumulators are filled once
   from the counts, every shared node is added up once, and the items add up
   their nodes. A task keeps the best of each item; the tasks' lists are merged.

Documents are never shuffled, a document with very many terms is read in
slices, and what is broadcast is a block's graph and weights, bounded by
``BLOCK_TERMS``.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.storage import materialize, release

TOP = 20
BLOCK_TERMS = 100_000    # (item, term) rows of a block of items, on average
CELLS = 4_000_000        # accumulators held at once: nodes x documents
SLICE = 1 << 20          # bytes of a text that are split into terms at a time
MERGERS = 16             # tasks that merge an item's lists first

# Letters, digits and everything beyond ASCII make terms; A-Z become a-z.
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def text_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists that cover about ``SLICE`` bytes each."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= SLICE else folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


# ------------------------------------------------------------------------------ mining

class Shared:
    """The query-sharing graph of a block of items.

    ``atom_of``: term -> atom. ``sums``: for every further node its two parts
    ``(left, times, right, times)``, in the order in which they can be added
    up. ``items``: per item its ``(node, times)`` list.
    """

    def __init__(self, items: list[Counter]):
        holders: dict[bytes, list] = defaultdict(list)
        for i, counts in enumerate(items):
            for term, times in counts.items():
                holders[term].append((i, times))
        atoms: dict[tuple, int] = {}
        self.atom_of = {term: atoms.setdefault(tuple(held), len(atoms)) for term, held in sorted(holders.items())}
        self.n_atoms = len(atoms)
        lists: list[list] = [[] for _ in items]
        for held, atom in sorted(atoms.items(), key=lambda x: (-len(x[0]), x[1])):
            for i, times in held:
                lists[i].append((atom, times))
        self.sums: list[tuple[int, int, int, int]] = []
        self.items = lists
        while self._join_neighbours():
            pass

    def _join_neighbours(self) -> bool:
        """One round: neighbours found twice or more become a node where no better pair overlaps."""
        found = Counter(pair for seq in self.items for pair in zip(seq, seq[1:], strict=False))
        wanted = {pair: n for pair, n in found.items() if n > 1}
        places: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for k, seq in enumerate(self.items):
            i = 0
            while i < len(seq) - 1:
                here, after = (wanted.get(tuple(seq[j:j + 2]), 0) for j in (i, i + 1))
                if here and here >= after:
                    places[tuple(seq[i:i + 2])].append((k, i))
                    i += 2
                else:
                    i += 1
        joined: dict[tuple[int, int], int] = {}
        for ((left, a), (right, b)), at in sorted(places.items()):
            if len(at) > 1:  # used once it would save nothing
                joined |= dict.fromkeys(at, self.n_atoms + len(self.sums))
                self.sums.append((left, a, right, b))
        for k, seq in enumerate(self.items):
            out, i = [], 0
            while i < len(seq):
                node = joined.get((k, i))
                out.append(seq[i] if node is None else (node, 1))
                i += 1 if node is None else 2
            self.items[k] = out
        return bool(joined)

    def n_nodes(self) -> int:
        return self.n_atoms + len(self.sums)

    def n_additions(self) -> int:
        """Additions of accumulators per document block; without sharing, one per item and term."""
        return len(self.sums) + sum(len(seq) for seq in self.items)

    def scores(self, acc: np.ndarray) -> Iterator[np.ndarray]:
        """Per item the scores of a block of documents; ``acc`` (nodes x documents) has the atoms' sums."""
        for node, (left, a, right, b) in enumerate(self.sums, self.n_atoms):
            acc[node] = acc[left] * a + acc[right] * b
        for seq in self.items:
            yield sum((acc[node] * times for node, times in seq), np.zeros(acc.shape[1], np.int64))


# ------------------------------------------------------------------------------ counting

def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = Counter(t for some in text_terms(text or b"") for t in some)
            rows.append((item_id, list(counts), list(counts.values())))
        ids, terms, times = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.list_(pa.binary())),
                                          pa.array(times, pa.list_(pa.int64()))], names=["item_id", "terms", "times"])


def _counted(vocabulary: dict[bytes, int]):
    """``doc_id, n, terms, times``: length, and the block's terms with their occurrences."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            lengths, sizes, terms, times = [], [], [], []
            for text in batch.column(1):
                n, counts = 0, Counter()
                for some in text_terms(text.as_py() or b""):
                    n += len(some)
                    ids = np.fromiter(map(get, some, repeat(-1)), np.int32, len(some))
                    values, found = np.unique(ids[ids >= 0], return_counts=True)
                    counts.update(dict(zip(values.tolist(), found.tolist(), strict=True)))
                lengths.append(n)
                sizes.append(len(counts))
                terms += counts
                times += counts.values()
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))], names=["doc_id", "n", "terms", "times"])
    return run


def term_weights(n_docs: int, frequencies: dict[int, int], n_terms: int) -> np.ndarray:
    """``floor(1000 ln((2 N + 2) / (2 df + 1)))`` per term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequencies.get(t, 0) + 1)))
                     for t in range(n_terms)], np.int64)


# ------------------------------------------------------------------------------ scoring

def _best(scores: np.ndarray, absent: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` highest scores, equal ones by id, absent ids last."""
    if len(scores) > top:
        at = np.flatnonzero(scores >= np.partition(scores, -top)[-top])
        at = at[np.lexsort((ids[at], absent[at], -scores[at]))]
    else:
        at = np.lexsort((ids, absent, -scores))
    return at[:top]


def _ranked(shared: Shared, atoms: np.ndarray, weights: np.ndarray, n_docs: int, length: int, top: int):
    """The task's best documents of every item: ``item int, task int, doc_id long, score long``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        best = [(empty, empty.astype(bool), empty)] * len(shared.items)
        width = max(1, CELLS // max(1, shared.n_nodes()))
        for whole in batches:
            for start in range(0, whole.num_rows, width):
                batch = whole.slice(start, width)
                n = batch.num_rows
                absent = np.asarray(batch.column("doc_id").is_null())
                ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                # whole numbers of any size, then 64 bits again
                m = np.array([75 + 25 * x * n_docs // length for x in batch.column("n").to_pylist()], np.int64)
                sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(n), sizes)
                term = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
                tf = batch.column("times").flatten().to_numpy(zero_copy_only=False)
                acc = np.zeros((shared.n_nodes(), n), np.int64)
                np.add.at(acc, (atoms[term], doc), weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])))
                for i, scores in enumerate(shared.scores(acc)):
                    old, old_absent, old_ids = best[i]
                    at = np.flatnonzero(scores >= max(1, old[-1] if len(old) == top else 1))
                    if not len(at):
                        continue
                    at = at[_best(scores[at], absent[at], ids[at], top)]
                    s, a, d = (np.concatenate(x) for x in ((old, scores[at]), (old_absent, absent[at]), (old_ids, ids[at])))
                    keep = _best(s, a, d, top)
                    best[i] = s[keep], a[keep], d[keep]
        task = TaskContext.get().partitionId()
        for i, (scores, absent, ids) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), i, np.int32)), pa.array(np.full(len(scores), task, np.int32)),
                     pa.array(ids, pa.int64(), mask=absent), pa.array(scores)], names=["item", "task", "doc_id", "score"])
    return run


def _search_block(documents: DataFrame, rows: list, top: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` of one block of items (rows of item_id, terms, times)."""
    spark = documents.sparkSession
    shared = Shared([Counter(dict(zip(r["terms"], r["times"], strict=True))) for r in rows])
    vocabulary = {term: k for k, term in enumerate(shared.atom_of)}
    atoms = np.array(list(shared.atom_of.values()), np.int64)
    counted = materialize(documents.mapInArrow(_counted(vocabulary), "doc_id long, n long, terms array<int>, times array<long>"),
                          "lexical-counts", {"docs": F.sum((F.col("n") > 0).cast("long")), "length": F.sum("n")})
    n_docs, length = (int(counted._tessera_metrics[x] or 0) for x in ("docs", "length"))
    df = {r["t"]: r["df"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t")
          .agg(F.count(F.lit(1)).alias("df")).toLocalIterator()}  # the block's terms at most
    weights = term_weights(n_docs, df, len(vocabulary))
    found = counted.filter("n > 0").mapInArrow(_ranked(shared, atoms, weights, n_docs, length, top),
                                               "item int, task int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = (found.withColumn("merger", F.col("task") % MERGERS)
            .withColumn("rank", F.row_number().over(Window.partitionBy("item", "merger").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("rank"))
    ranked = (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
              .filter(F.col("rank") <= top))
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
    out = materialize(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "lexical-ranks")
    release(counted)
    return out


def rank_documents(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                   item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` documents with a score above 0.

    Terms are maximal runs of letters, digits and characters beyond ASCII,
    A-Z lower-cased; null and empty texts have none. A document's score is the
    sum over the item's terms (repeats included) of the term's weight times
    its damped frequency, in whole numbers; equal scores go by ascending key.
    Every row is a document, also one that repeats a key; a row without a key
    comes last among equal scores and is returned without one. Items without
    terms, and documents without terms, give no rows; an item row that repeats
    an id gives its rows again. Empty tables give no rows; further columns are
    not read.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    terms = (items.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text"))
             .mapInArrow(_item_terms, "item_id long, terms array<binary>, times array<long>").filter(F.size("terms") > 0))
    terms = materialize(terms.withColumn("h", F.xxhash64("item_id", "terms")), "lexical-items", {"n": F.sum(F.size("terms"))})
    blocks = -(-int(terms._tessera_metrics["n"] or 0) // block_terms)
    out = None
    for b in range(blocks):
        rows = terms.filter(F.pmod("h", F.lit(blocks)) == b).select("item_id", "terms", "times").collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["terms"]))
        if rows:
            found = _search_block(docs, rows, top)
            out = found if out is None else out.unionByName(found)
    release(terms)
    if out is None:
        out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def op13(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return rank_documents(documents, benchmark)
