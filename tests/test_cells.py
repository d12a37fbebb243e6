"""Families of near copies: compared cell by cell, no row a pair and part, no text a pair."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import hashing
from tessera.operators import cells, exact, similarity
from tessera.sources import storage
from tests.test_exact_parts import K, brute_force


def family(rng, members=45, length=260, words=(0, 1, 2, 5, 12)):
    base = rng.choices("abcdefgh ", k=length)
    out = []
    for _ in range(members):
        text = list(base)
        for _ in range(rng.choice(words)):
            at = rng.randrange(len(text))
            text[at:at + 2] = rng.choices("abcdefgh ", k=3)
        out.append("".join(text))
    return out


def families(rng):
    texts = [*family(rng), *family(rng, 30, 600), *family(rng, 25, 40, (0, 1)), *family(rng, 20, 90)]
    texts += [t + "".join(rng.choices("xyz", k=len(t) // 12)) for t in texts[::3]]
    texts += ["".join(rng.choices("abc", k=rng.randint(5, 200))) for _ in range(20)]
    return dict(enumerate(dict.fromkeys(texts)))


@pytest.fixture
def stored(monkeypatch):
    """Rows of the tables that the exact join writes."""
    rows = {}

    def kept(df, name="table", metrics=None):
        out = storage.materialize(df, name, metrics)
        rows[name] = rows.get(name, 0) + out._tessera_rows
        return out
    for module in (exact, cells):
        monkeypatch.setattr(module, "materialize", kept)
    return rows


@pytest.mark.parametrize("block, crowd, small", [(1 << 20, 16, 50_000), (6000, 2, 0), (6000, 16, 0), (1, 3, 50_000)])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_families_equal_brute_force(spark, monkeypatch, block, crowd, small, kind):
    monkeypatch.setattr(cells, "BLOCK", block)
    monkeypatch.setattr(exact, "CROWD", crowd)
    monkeypatch.setattr(similarity, "SMALL", small)
    texts = families(random.Random(5))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = {(r.first, r.second): r.similarity for r in exact.exact_similar_texts(docs, 0.85, K, docs.select("doc_id")).collect()}
    want = brute_force(texts, 0.85)
    if kind == "string":
        want = {tuple(sorted((str(i), str(j)))): s for (i, j), s in want.items()}
    assert len(want) > 100 and got == want


def test_no_rows_for_the_pairs_of_a_family(spark, stored):
    """A family of m sets shares hundreds of parts: neither are its m^2 / 2 pairs written as candidates, nor its texts sent to each."""
    texts = dict(enumerate(family(random.Random(6), 120, 700, (0, 1, 2))))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = exact.exact_similar_texts(docs, 0.85, K, docs.select("doc_id"))
    assert got._tessera_rows > 2000
    assert stored["exact_candidates"] < 300, stored
    assert stored["cell_texts"] <= 150, stored
    assert got._tessera_metrics["candidates"] >= got._tessera_rows


def test_chance_meetings_are_not_verified(spark, stored):
    """Texts with a common passage share parts, but fewer than similar ones have to."""
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefgh ", k=150))
    texts = ["".join(rng.choices("ijklmnop ", k=250)) + passage for _ in range(14)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = [set().union(*(p.tolist() for p, _ in exact.kept_parts(
        hashing.text_shingle_hashes(t, np.array(hashing.shingle_weights(K), dtype=np.int64)), 0.85))) for t in texts]
    assert any(parts[i] & parts[j] for i in range(14) for j in range(i))
    assert exact.exact_similar_texts(docs, 0.85, K, docs.select("doc_id"))._tessera_rows == 0
    assert stored["exact_candidates"] == 0, stored


@pytest.mark.parametrize("threshold", [0.5, 0.85, 0.95])
def test_similar_sets_share_as_many_parts_as_is_asked(threshold):
    rng = random.Random(3)
    for n in [*range(1, 60), 100, 333, 1000, 3000]:
        for larger in {n, int(n / threshold)}:
            common = next(c for c in range(n + 1) if c >= threshold * (n + larger - c) - 1e-9)
            tokens = rng.sample(range(1 << 32), n + larger - common)
            y, x = np.array(tokens[:n], np.int64), np.array(tokens[n - common:], np.int64)
            own = next((set(p.tolist()), least) for p, below, least in exact.counted_parts(y, threshold) if not below)
            met = max(len(own[0] & set(p.tolist())) for p, _, _ in exact.counted_parts(x, threshold))
            assert met >= own[1], (n, larger)


def test_listed_pairs_equal_pairs_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 5000)
    texts = families(random.Random(7))
    docs = spark.createDataFrame([(i, t) for i, t in texts.items() if len(t) >= K], "doc_id long, text string")
    pairs = (docs.select(F.col("doc_id").alias("first")).crossJoin(docs.select(F.col("doc_id").alias("second")))
             .filter("first < second and (first * second) % 3 = 0").withColumn("note", F.struct("first", F.lit("x").alias("s"))))
    pairs = pairs.unionByName(pairs.limit(5)).unionByName(pairs.limit(3).withColumn("second", F.lit(10 ** 9).cast("long")))
    rows = lambda df: sorted((r.first, r.second, r.note.first, r.similarity) for r in df.collect())
    behind = []
    listed = rows(similarity.text_pair_similarity(pairs, docs, K, behind=behind))
    storage.release(*behind)
    monkeypatch.setattr(similarity, "SMALL", 1 << 40)
    assert behind and listed == rows(similarity.text_pair_similarity(pairs, docs, K))


def test_common_counts_by_products_and_by_merges(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n)) for n in (0, 1, 5000, *rng.integers(1500, 4000, 60))]
    i, j = np.nonzero(np.triu(np.ones((len(sets), len(sets))), 1))
    for columns in (100, 4096):
        monkeypatch.setattr(cells, "COLUMNS", columns)
        for pick in (slice(None), slice(0, 1500), slice(None, None, 50), slice(3, 4)):
            want = [np.intersect1d(sets[a], sets[b]).size for a, b in zip(i[pick], j[pick])]
            assert cells.common_counts(sets, i[pick], j[pick]).tolist() == want


def test_minhash_of_low_bits_equals_64_bit_arithmetic():
    """Ties in the low bits, values that wrap around, shingles beyond 32 bits."""
    params = hashing.hash_family(143, 1)
    a, b = (np.array(v, dtype=np.int64) for v in zip(*params))
    odd_a = np.array([2 ** 30, 2 ** 31 - 2, 1, 2, 4, 2 ** 20, 3, 65536], dtype=np.int64)
    odd_b = np.array([0, 1, 2 ** 32 - 1, 2 ** 32 - 3, 5, 2 ** 32 - 2, 2 ** 32 - 4, 7], dtype=np.int64)
    rng = np.random.default_rng(2)
    for x in (np.arange(3000), np.arange(2 ** 32 - 3000, 2 ** 32), np.arange(4000) << 20, np.unique(rng.integers(0, 2 ** 32, 5000)),
              np.unique(rng.integers(-5, 2 ** 40, 500)), np.arange(128), np.arange(3)):
        for p, q in ((a, b), (odd_a, odd_b)):
            assert hashing.minhash_kernel(p, q)(x).tolist() == hashing._minhash_wide(x, p, q).tolist()


def test_minhash_multiplies_whole_shingle_blocks_once(monkeypatch):
    """Few shingles of a long text are computed in 64 bits (all of them before)."""
    a, b = (np.array(v, dtype=np.int64) for v in zip(*hashing.hash_family(143, 1)))
    seen = []
    reduced = hashing._reduced
    monkeypatch.setattr(hashing, "_reduced", lambda v: seen.append(v.size) or reduced(v))
    x = np.unique(np.random.default_rng(3).integers(0, 2 ** 32, 20_000))
    hashing.minhash_block(x, a, b)
    assert sum(seen) < 0.02 * 143 * x.size


def test_part_rows_travel_packed(spark, monkeypatch):
    """A binary value for each task that rows go to, not a row for each part; what comes out has its part with another set."""
    import pyarrow as pa
    rng = np.random.default_rng(4)
    part = rng.integers(0, 1 << exact.PART_BITS, 5000)
    part[::7] = part[3]
    size = np.arange(1, 5001) * np.where(np.arange(5000) % 3 == 0, -1, 1)
    for ids in (pa.array([f"é{i}" for i in range(5000)]), pa.array(rng.permutation(5000) - 2500)):
        packed = exact._packed(ids, part, size, 9)
        assert packed.column(0).to_pylist() == list(range(9))
        out = pa.Table.from_batches(exact._shared(ids.type, 0.85)([packed]))
        want = {(ids[i].as_py(), part[i], size[i]): n for i, n in enumerate((part[:, None] == part[None, :]).sum(axis=1)) if n > 1}
        assert len(want) == 716 and dict(zip(zip(*(out[c].to_pylist() for c in ("id", "part", "size"))), out["sets"].to_pylist())) == want
        for n, least in set(zip(out["size"].to_pylist(), out["least"].to_pylist())):
            tokens = np.unique(rng.integers(0, 1 << 32, 2 * abs(n)))[:abs(n)]
            assert least == next((c for _, below, c in exact.counted_parts(tokens, 0.85) if below == (n < 0)), least)
        assert not list(exact._shared(ids.type, 0.85)([]))
