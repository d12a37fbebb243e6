"""Sketches, the filters of the exact join, and the stored LSH index."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.functions.sketches import Bloom, CountMin
from tessera.operators import exact
from tessera.operators import similarity as sim
from tessera.operators.joins import salted_join
from tessera.plans import catalog, registry
from tessera.plans.lsh_index import LshIndex, build_index
from tessera.plans.near_duplicates import LshParams, exact_key_pairs, find_near_duplicates, sign_documents
from tessera.sources.storage import new_folder


def jaccard_pairs(sets, t):
    out = {}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
                if j >= t:
                    out[a, b] = j
    return out


def frame(spark, sets):
    return spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "doc_id long, shingles array<long>")


def test_count_min_never_undercounts(spark):
    rng = random.Random(1)
    sets = {i: {rng.randrange(4000) for _ in range(60)} for i in range(200)}
    true = Counter(x for s in sets.values() for x in s)
    tokens = np.array(sorted(true))
    for width in (256, 1 << 16):
        counts = CountMin.of(frame(spark, sets).repartition(7), "shingles", width).counts(tokens)
        assert all(c >= true[t] for t, c in zip(tokens.tolist(), counts.tolist()))
    assert (counts == [true[t] for t in tokens.tolist()]).mean() > 0.95


def test_bloom_has_no_false_negatives(spark):
    ids = spark.range(5000).select((F.col("id") * 3).alias("doc_id"))
    everything = spark.range(15000).select(F.col("id").alias("doc_id"))
    for bits, most in ((1 << 12, 10_000), (1 << 18, 100)):
        hits = {r.doc_id for r in everything.filter(Bloom.of(ids, "doc_id", bits).may_hold("doc_id")).collect()}
        assert {3 * i for i in range(5000)} <= hits and len(hits) - 5000 <= most
    assert everything.filter(Bloom.of(ids.limit(0), "doc_id", 1 << 12).may_hold("doc_id")).count() == 0


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 0.85, 1.0])
def test_exact_join_equals_brute_force(spark, threshold):
    rng = random.Random(int(threshold * 100))
    base = [rng.sample(range(300), rng.randint(1, 60)) for _ in range(12)]
    sets = {}
    for i in range(120):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            s ^= {rng.randrange(300)}
        sets[i] = s
    sets[200] = set()
    want = jaccard_pairs(sets, threshold)
    for width in (64, 1 << 14):
        got = exact.exact_similar_pairs(frame(spark, sets).repartition(5), threshold, width=width)
        assert {(r.first, r.second): r.similarity for r in got.collect()} == want
        assert got._tessera_metrics["candidates"] >= len(want)


def test_exact_join_without_suffix_counts_and_with_salting(spark, monkeypatch):
    rng = random.Random(3)
    sets = {i: set(range(20)) ^ {rng.randrange(40) for _ in range(rng.randint(0, 4))} for i in range(80)}
    monkeypatch.setattr(exact, "salted_join", lambda a, b, keys, largest: salted_join(a, b, keys, largest, cell=9))
    got = exact.exact_similar_pairs(frame(spark, sets), 0.7)
    assert {(r.first, r.second): r.similarity for r in got.collect()} == jaccard_pairs(sets, 0.7)
    full = {1: set(range(70_000)), 2: set(range(1000, 70_000))}  # more than 16 bits in a class
    got = exact.exact_similar_pairs(frame(spark, full), 0.9).collect()
    assert [(r.first, r.second) for r in got] == [(1, 2)]


def test_prefix_rows_come_from_one_row_each(spark):
    """No exchange before the prefixes: tokens are cut where their set is."""
    df = frame(spark, {i: set(range(i, i + 30)) for i in range(20)})
    sketch = CountMin.of(df, "shingles", 1 << 10)
    plan = exact.prefix_tokens(df, 0.8, sketch=sketch)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_salted_join_equals_plain_join(spark):
    rng = random.Random(5)
    a = spark.createDataFrame([(rng.choice("xxxxy"), i) for i in range(60)], "k string, a long")
    b = spark.createDataFrame([(rng.choice("xxxyz"), i) for i in range(50)], "k string, b long")
    want = Counter((r.k, r.a, r.b) for r in a.join(b, "k").collect())
    assert Counter((r.k, r.a, r.b) for r in salted_join(a, b, ["k"], 60, cell=7).select("k", "a", "b").collect()) == want


def test_candidates_of_the_corpus_are_few(spark):
    nd = find_near_duplicates(catalog.documents(spark, SF001))
    found = exact_key_pairs(nd)
    assert found._tessera_rows <= found._tessera_metrics["candidates"] <= 3 * max(1, found._tessera_rows)


def test_text_similarity_equals_set_similarity(spark):
    texts = {1: "abcdefghijklmnop", 2: "abcdefghijklmnoq", 3: "ÄÖÜ äöü 🙂🙂🙂 xyz", 4: "ÄÖÜ äöü 🙂🙂🙂 xyy", 5: "zzzzzzzzzzzzz"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2), (3, 4), (1, 5)], "first long, second long")
    sets = sim.shingles(docs)
    key = lambda df: {(r.first, r.second): r.similarity for r in df.collect()}
    assert key(sim.text_pair_similarity(pairs, docs)) == key(sim.pair_similarity(pairs, sets))
    assert key(sim.similar_pairs(pairs, sets, 0.5)) == {p: s for p, s in key(sim.pair_similarity(pairs, sets)).items() if s >= 0.5}


# ------------------------------------------------------------------ the index

def corpus(spark, extra=()):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = []
    for c in range(12):
        text = " ".join(word() for _ in range(60))
        rows.append((10 * c, text))
        rows += [(10 * c + 1 + i, text if i % 2 else text[:-9] + " changed") for i in range(rng.randint(0, 4))]
    rows += [(500, None), (501, ""), (502, "short"), (None, rows[0][1])]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string")


def test_lookup_equals_pair_table(spark):
    docs = corpus(spark)
    nd = find_near_duplicates(docs)
    index = build_index(sign_documents(docs), new_folder(spark, "test-index"), parts=4)
    queries = docs.filter("doc_id % 3 = 0 or doc_id > 400")
    want = {tuple(r) for r in sim.similar_to(nd.similar_pairs(), queries).collect()}
    again = LshIndex(spark, index.path)   # a restarted driver opens it by its path
    assert again.params == LshParams() and len(want) > 10
    for i in (index, again):
        got = i.lookup(queries)
        assert {(r.doc_id, r.similar_id) for r in got.collect()} == want
    similarity = {(r.first, r.second): r.similarity for r in nd.similar_pairs().collect()}
    assert all(similarity[min(r.doc_id, r.similar_id), max(r.doc_id, r.similar_id)] == r.similarity for r in got.collect())


def test_lookup_of_documents_that_are_not_indexed(spark):
    docs = corpus(spark)
    index = build_index(sign_documents(docs), new_folder(spark, "test-index"))
    text = docs.filter("doc_id = 0").first().text
    new = spark.createDataFrame([(9001, text), (9002, "nothing like it in the whole corpus"), (9003, None), (9004, "x")],
                                "doc_id long, text string")
    got = {(r.doc_id, r.similar_id) for r in index.lookup(new).collect()}
    assert {q for q, _ in got} == {9001} and (9001, 0) in got
    assert index.lookup(new.limit(0)).count() == 0


def test_lookup_reads_only_probed_folders(spark):
    docs = corpus(spark)
    index = build_index(sign_documents(docs), new_folder(spark, "test-index"), parts=16)
    wanted = spark.createDataFrame([(3, 1), (3, 2)], "band int, part int")
    probed = index._in_parts("buckets", wanted, ["band", "part"])
    plan = probed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert {(r.band, r.part) for r in probed.select("band", "part").distinct().collect()} <= {(3, 1), (3, 2)}


def test_index_of_repeated_ids_and_nothing(spark):
    docs = corpus(spark, [(0, "another text under the same id, long enough"), (0, None)])
    nd = find_near_duplicates(docs)
    index = build_index(sign_documents(docs), new_folder(spark, "test-index"))
    queries = nd.docs.filter("doc_id < 30")
    assert ({(r.doc_id, r.similar_id) for r in index.lookup(queries).collect()}
            == {tuple(r) for r in sim.similar_to(nd.similar_pairs(), queries).collect()})
    empty = build_index(sign_documents(docs.limit(0)), new_folder(spark, "test-index"))
    assert empty.lookup(docs).count() == 0


def test_memo_sees_a_replaced_input(spark, tmp_path):
    write = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(
        str(tmp_path / "documents.parquet"))
    text = "the quick brown fox jumps over the lazy dog"
    write([(1, text), (2, text)])
    assert registry.q_similar_pairs(spark, str(tmp_path)).count() == 1
    write([(1, text), (2, text), (3, text)])
    assert registry.q_similar_pairs(spark, str(tmp_path)).count() == 3
