"""Prefix trie of conversations that share heads, by composable fingerprints.

A conversation is rebuilt from the head of another one and the rest of its own
turns. Neither is put together here: the fingerprint of a sequence of turns
``t_0 .. t_{n-1}`` is the pair ``(n, sum of t_j * B^j mod p)``, and

    (n, x) o (m, y) = (n + m, x + B^n * y)

is the fingerprint of one sequence after another, an associative product with
the empty sequence ``(0, 0)`` as its one. Prefixes of stored conversations are
running sums; the suffix of a conversation after its first ``h`` turns is
``B^-h * (x_n - x_h)``; so every prefix of a rebuilt conversation comes from
three stored numbers. Four primes below 2^31 make 124 bits.

Rows of equal depth and fingerprint are a node. Its members are verified to be
equal: each row refers to a stored turn, turns of equal hash are compared by
their text, and all rows of a node must refer to equal turns. (Equal products
less equal last terms are equal products one turn earlier, so that settles the
whole prefix.) If a comparison fails, all is done again with other hashes.

A node is named by its smallest member and its depth. Sums over subtrees need
no walk down the levels: a leaf is counted on the path of its smallest member,
and a conversation's own nodes (those it is the smallest member of) are the
deep end of its path, so a subtree sum is one aggregation over path rows plus
one running sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sketches import Bloom
from tessera.sources.storage import materialize, release

from .common import words
from .running import running_sums

# Four primes below 2^31 and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525, 134775813, 214013)
SALTS = 4        # hashes tried before giving up
IDS = 4096       # characters of joined ids in a piece of a list
TRIE_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
            "ends_sha256 string")
_EMPTY = hashlib.sha256(b"").hexdigest()


def _powers(exponents: np.ndarray, lane: int) -> np.ndarray:
    """``BASES[lane] ^ exponents mod PRIMES[lane]`` by squaring."""
    p, square, out, left = PRIMES[lane], BASES[lane], np.ones(len(exponents), np.int64), exponents.copy()
    while left.any():
        out = np.where(left & 1, out * square % p, out)
        square, left = square * square % p, left >> 1
    return out


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``x0 .. x3``: the turn's hash times the base to the power of its place, in every lane."""
    for batch in batches:
        pos = batch.column("pos").to_numpy(zero_copy_only=False)
        hashes = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2")]
        lanes = [(hashes[lane // 2] >> (31 * (lane % 2))) % p for lane, p in enumerate(PRIMES)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(x * _powers(pos, lane) % PRIMES[lane]) for lane, x in enumerate(lanes)]],
            names=[*batch.schema.names, *[f"x{lane}" for lane in range(4)]])


def turn_table(turns: DataFrame, salt: int) -> DataFrame:
    """``conv_id, turn, h1, h2, role, text`` with both hashes of (role, text)."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    h = lambda k: F.xxhash64(F.lit(2 * salt + k), *said)
    return turns.select("conv_id", "turn", h(0).alias("h1"), h(1).alias("h2"), said[0].alias("role"), said[1].alias("text"))


def _turn_references(narrow: DataFrame) -> DataFrame:
    """``h1, h2, ref, n``: per turn hash the stored turn ``(conv_id, pos)`` that stands for it."""
    return narrow.groupBy("h1", "h2").agg(F.min(F.struct("conv_id", "pos")).alias("ref"), F.count(F.lit(1)).alias("n"))


def _texts_differ(turns: DataFrame, references: DataFrame) -> bool:
    """Whether turns of one hash have different roles or texts.

    Turns that are alone with their hash are left out by a Bloom filter in
    the scan; copies of a turn, however many, meet in the tasks first.
    """
    h = F.xxhash64("h1", "h2")
    shared = references.filter("n > 1").select(h.alias("h"))
    said = F.struct("role", "text")
    return bool(turns.filter(Bloom.of(shared, "h").may_hold(h)).groupBy("h1", "h2")
                .agg(F.min(said).alias("low"), F.max(said).alias("high")).filter("low <> high").limit(1).count())


def _mod(x: Column, lane: int) -> Column:
    return F.pmod(x, F.lit(PRIMES[lane]).cast("long"))


def _key(lanes: list[Column]) -> list[Column]:
    return [(F.shiftleft(lanes[k], 31).bitwiseOR(lanes[k + 1])).alias(f"k{k // 2}") for k in (0, 2)]


def _paths(stored: DataFrame, spec: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all non-empty prefixes of the rebuilt conversations, and ``(conv_id, length)`` of each.

    ``stored`` has a row per turn (``conv_id, pos, words, ref, x0_sum ..``),
    ``spec`` a row per conversation (``conv_id, base, head``).
    """
    lane_sums = [f"x{lane}_sum" for lane in range(4)]
    lengths = stored.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    conv = spec.join(lengths, "conv_id").join(
        lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    conv = conv.select("conv_id", "base", "head", F.least("head", F.coalesce("base_n", F.lit(0))).alias("taken"),
                       F.greatest(F.col("n") - F.col("head"), F.lit(0)).alias("rest"))
    # fingerprints of two heads: the taken one and the one that is left out
    at = stored.select(F.col("conv_id").alias("of"), (F.col("pos") + 1).alias("depth"), F.struct(*lane_sums).alias("x"))
    heads = at.filter(F.col("depth") <= F.lit(int(spec._tessera_metrics["most"] or 0)))
    conv = (conv.join(heads.select(F.col("of").alias("base"), F.col("depth").alias("taken"), F.col("x").alias("x_base")),
                      ["base", "taken"], "left")
            .join(heads.select(F.col("of").alias("conv_id"), F.col("depth").alias("head"), F.col("x").alias("x_own")),
                  ["conv_id", "head"], "left"))
    conv = conv.withColumns({f"shift{k}": _power(F.col("head") - F.col("taken"), pow(BASES[k], -1, p), p)
                             for k, p in enumerate(PRIMES)})
    conv = materialize(conv, "trie-conversations")
    # prefixes inside the taken head are prefixes of the base
    inside = (conv.filter("taken > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(1).cast("long"), "taken")).alias("depth"))
              .join(stored.select(F.col("conv_id").alias("base"), (F.col("pos") + 1).alias("depth"), "words", "ref", *lane_sums),
                    ["base", "depth"])
              .select("conv_id", "depth", "words", "ref", *_key([_mod(F.col(c), k) for k, c in enumerate(lane_sums)])))
    # beyond it: base head o own suffix; taken <= head, so B^(taken - head) is a power of the inverse
    own = stored.join(conv.filter("rest > 0").select("conv_id", "head", "taken", "x_base", "x_own", *[f"shift{k}" for k in range(4)]), "conv_id").filter("pos >= head")
    lanes = []
    for k, c in enumerate(lane_sums):
        shift = F.col(f"shift{k}")
        head = lambda side, c=c: F.coalesce(F.col(f"{side}.{c}"), F.lit(0))
        lanes.append(_mod(_mod(head("x_base"), k) + shift * _mod(F.col(c) - head("x_own"), k), k))
    beyond = own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("head") + 1).alias("depth"), "words", "ref", *_key(lanes))
    return inside.unionByName(beyond), conv.select("conv_id", (F.col("taken") + F.col("rest")).alias("length"))


def _power(exponent: Column, base: int, p: int) -> Column:
    """``base ^ exponent mod p`` by squaring, for exponents below 2^16."""
    one = F.lit(1).cast("long")
    factors = F.array(*[F.when(F.shiftright(exponent, bit).bitwiseAND(1) == 1, F.lit(pow(base, 1 << bit, p)).cast("long"))
                        .otherwise(one) for bit in range(16)])
    return F.aggregate(factors, one, lambda acc, x: F.pmod(acc * x, F.lit(p).cast("long")))


def _hashed_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the joined pieces of every node; the pieces come in order and are not kept."""
    now, digest = None, None
    for batch in batches:
        out = []
        for rep, depth, piece in zip(*[batch.column(c).to_pylist() for c in ("rep", "depth", "piece")], strict=True):
            if (rep, depth) != now:
                if digest:
                    out.append((*now, digest.hexdigest()))
                now, digest = (rep, depth), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield _list_rows(out)
    if digest:
        yield _list_rows([(*now, digest.hexdigest())])


def _list_rows(rows: list) -> pa.RecordBatch:
    reps, depths, texts = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(depths, pa.int64()), pa.array(texts, pa.string())],
                                      names=["rep", "depth", "ends_sha256"])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node joined to pieces of about ``IDS`` characters."""
    def row(key: tuple, ids: list[str]) -> tuple:
        return (*key, int(ids[0]), ",".join(ids))

    now, ids, size = None, [], 0
    for batch in batches:
        out = []
        for rep, depth, conv in zip(*[batch.column(c).to_pylist() for c in ("rep", "depth", "conv_id")], strict=True):
            if ids and ((rep, depth) != now or size >= IDS):
                out.append(row(now, ids))
                ids, size = [], 0
            now = (rep, depth)
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _piece_rows(out)
    if ids:
        yield _piece_rows([row(now, ids)])


def _piece_rows(rows: list) -> pa.RecordBatch:
    reps, depths, firsts, texts = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(reps, pa.int64()), pa.array(depths, pa.int64()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())],
        names=["rep", "depth", "first", "piece"])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """``rep, depth, ends_sha256`` from ``rep, depth, conv_id`` rows: the hash of the ids in order, joined by commas.

    The ids are sorted and joined to pieces in all tasks. One node's pieces
    then pass one task, since SHA-256 takes its input in order; the task keeps
    nothing but the state of the hash.
    """
    order = ["rep", "depth", "conv_id"]
    pieces = (ends.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(_pieces, "rep long, depth long, first long, piece string"))
    return (pieces.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first")
            .mapInArrow(_hashed_lists, "rep long, depth long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, spec: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node.

    ``conversations`` has ``conv_id, turn, role, text``; ``spec`` names for
    every ``conv_id`` the conversation ``base`` whose first ``head`` turns
    (fewer, if it has fewer; none, if it isn't there; 65,535 at most) stand
    before the conversation's own turns after its first ``head``. Returned
    are ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``.

    Turns are ordered by ``turn`` with null first, equal ones by their hash,
    and a repeated row is a turn of its own; null roles and texts count as
    empty. Rows without a ``conv_id`` belong to no conversation and are left
    out. A conversation may turn out empty: it is a member of the root alone.
    An empty table has no members, hence no root and no rows. Further columns
    are not read.
    """
    given = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    given = given.filter("conv_id is not null")
    spec = materialize(spec.select("conv_id", "base", F.col("head").cast("long").alias("head")), "trie-spec",
                       {"most": F.max("head")})
    if not spec._tessera_rows:
        return given.sparkSession.createDataFrame([], TRIE_DDL)
    for salt in range(SALTS):
        turns = turn_table(given, salt)
        narrow = materialize(turns.select(
            "conv_id", "turn", "h1", "h2", F.size(words(F.col("text"))).cast("long").alias("words"),
            F.lit(1).cast("long").alias("one")), "trie-turns")
        placed = running_sums(narrow, ["conv_id"], ["turn", "h1", "h2"], ["one"], "trie-places")
        release(narrow)
        placed_turns = placed.select("conv_id", (F.col("one_sum") - 1).alias("pos"), "h1", "h2", "words")
        references = materialize(_turn_references(placed_turns), "trie-references")
        if _texts_differ(turns, references):
            release(placed, references)
            continue
        lanes = "".join(f", x{k} long" for k in range(4))
        summed = running_sums(placed_turns.mapInArrow(_terms, f"conv_id long, pos long, h1 long, h2 long, words long{lanes}"),
                              ["conv_id"], ["pos"], [f"x{k}" for k in range(4)], "trie-prefixes")
        stored = summed.join(references.select("h1", "h2", "ref"), ["h1", "h2"])
        prefixes, lengths = _paths(stored, spec)
        paths = materialize(prefixes, "trie-paths")
        nodes = materialize(
            paths.groupBy("depth", "k0", "k1").agg(
                F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
                F.min("ref").alias("ref"), F.max("ref").alias("other")),
            "trie-nodes", {"unequal": F.count_if(F.col("ref") != F.col("other"))})
        if not nodes._tessera_metrics["unequal"]:
            lengths = materialize(lengths, "trie-lengths")
            out = _tree(paths, nodes, lengths)
            release(spec, placed, references, summed, paths, nodes, lengths)
            return out
        release(placed, references, summed, paths, nodes)
    raise RuntimeError("every hash tried took different turns or prefixes for equal")


def _tree(paths: DataFrame, nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    spark = paths.sparkSession
    root = lengths.agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n")).first()
    if not root["n"]:
        return spark.createDataFrame([], TRIE_DDL)
    # every path row by the name of its node; depth 0 is the root
    named = materialize(paths.select("conv_id", "depth", "k0", "k1").join(
        nodes.select("depth", "k0", "k1", "rep", "words", "n_convs"), ["depth", "k0", "k1"])
        .select("conv_id", "depth", "rep", "words", "n_convs"), "trie-named")
    own = named.filter("conv_id = rep").withColumn("spared", (F.col("n_convs") - 1) * F.col("words"))
    parents = named.select(F.col("conv_id").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent"))
    own = own.select("rep", "depth", "n_convs", "spared").join(parents, ["rep", "depth"], "left").withColumn(
        "parent", F.when(F.col("depth") == 1, F.lit(root["rep"])).otherwise(F.col("parent")))
    own = running_sums(own, ["rep"], ["depth"], ["spared"], "trie-own")
    children = materialize(own.groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth"))
                           .agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    leaves = own.select("rep", "depth").join(children, ["rep", "depth"], "left_anti")
    totals = own.groupBy("rep").agg(F.sum("spared").alias("total"))
    # per conversation: what its own nodes spare, and whether it ends in a leaf that it names
    carried = (totals.join(leaves.select("rep", F.lit(1).alias("leaf")), "rep", "left")
               .select(F.col("rep").alias("conv_id"), "total", F.coalesce("leaf", F.lit(0)).alias("leaf")))
    sums = materialize(named.join(carried, "conv_id").groupBy("rep", "depth").agg(
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(F.col("conv_id") != F.col("rep"), F.col("total")).otherwise(0)).alias("others")), "trie-sums")
    ends = lengths.join(named.select("conv_id", F.col("depth").alias("length"), "rep"), ["conv_id", "length"], "left").select(
        F.coalesce("rep", F.lit(root["rep"])).alias("rep"), F.col("length").alias("depth"), "conv_id")
    hashes = materialize(ends_hashes(ends), "trie-ends")
    whole = own.agg(F.sum("spared").alias("spared"), F.count_if(F.col("depth") == 1).alias("children")).first()
    top = spark.createDataFrame(
        [(root["rep"], 0, None, root["n"], whole["children"], max(1, leaves.count()), whole["spared"] or 0)],
        "rep long, depth long, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    below = (own.join(totals, "rep").join(sums, ["rep", "depth"]).join(children, ["rep", "depth"], "left").select(
        "rep", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
        (F.col("others") + F.col("total") - F.col("spared_sum") + F.col("spared")).alias("saved_tokens")))
    out = materialize(
        below.unionByName(top).join(hashes, ["rep", "depth"], "left").select(
            F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")), "trie")
    release(named, own, children, sums, hashes)
    return out


def op12(conversations: DataFrame) -> DataFrame:
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id is not null").distinct()
    spec = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"),
                      (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("head"))
    return prefix_trie(conversations, spec)
