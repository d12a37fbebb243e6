import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from frames import awkward_docs, no_docs, words

from tessera.llm import embedding_dedup, graph, near_dedup
from tessera.llm.shingle_sets import shingle_set, word_hashes

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_set(text, size=2):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    return frozenset(zip(*[w[i:] for i in range(size)], strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_components(sets, percent=80):
    low = {k: k for k in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                low[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def test_hashed_sets_have_the_size_of_real_sets():
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a", "A a A a", "x\x85y z", "é É e", "word " * 50, " ".join(words(rng, 400))]
    texts += ["".join(rng.choices("ab \n\tÀ漢", k=rng.randint(0, 60))) for _ in range(300)]
    for size in (2, 5):
        got = [len(shingle_set(w, size)) for w in word_hashes(pa.array(texts))]
        assert got == [len(text_set(t, size)) for t in texts]


def test_long_texts_are_hashed_limb_by_limb():
    rng = random.Random(5)
    text = " ".join(words(rng, 300_000))  # over a million bytes
    whole, endless = list(word_hashes(pa.array([text, "a" * 3_000_000 + " tail"])))
    parts = np.concatenate([w for w in word_hashes(pa.array([text[:500_000].rpartition(" ")[0]]))])
    assert len(whole) == len(text.split()) and np.array_equal(whole[:len(parts)], parts) and len(endless) == 2


def test_near_duplicates_equal_brute_force(spark):
    docs, rows = awkward_docs(spark)
    got = near_dedup.near_duplicates(docs, shingle=2).collect()
    assert len(got) == len(rows)
    want = brute_components({i: text_set(t) for i, t, _, _ in rows if i is not None})
    named = [(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None]
    assert sorted(named) == sorted((i, want[i], i == want[i]) for i, *_ in rows if i is not None)
    assert sorted(r.n_shingles for r in got) == sorted(len(text_set(t)) for _, t, _, _ in rows)
    # a null id takes part by its text: one is a near copy of 1, the other has no text
    assert sorted((r.component_id is None, r.kept) for r in got if r.doc_id is None) == [(False, False), (True, True)]


def test_a_large_near_group_is_linked_completely(spark):
    rng = random.Random(9)
    base = words(rng, 60)
    rows = []
    for i in range(300):
        own = list(base)
        for at in rng.sample(range(60), rng.randint(1, 7)):
            own[at] = f"w{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
    assert got == brute_components({i: text_set(t) for i, t in rows})


def test_dropping_keeps_one_of_each_group(spark):
    docs, rows = awkward_docs(spark)
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
    comps = brute_components({i: text_set(t, 5) for i, t, _, _ in rows if i is not None})
    assert ids == sorted(i for i, c in comps.items() if i == c)
    repeated = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "d e f")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(repeated).collect()) == [1, 2]


def test_rows_without_a_key_are_documents_too(spark):
    """Two copies without a key leave one; beside a named copy none stays."""
    rows = [(None, "a b c d e f g h"), (None, "a b c d e f g h"), (None, "x y z x y z u"), (5, "x y z x y z u"), (6, "own words here"),
            (None, None), (None, "")]
    for shift in (0, 1 << 62):
        given = [(None if i is None else i + shift, t, "extra") for i, t in rows]
        docs = spark.createDataFrame(given, "doc_id long, text string, _number string")
        left = near_dedup.drop_near_duplicates(docs)
        assert left.columns == docs.columns
        got = Counter((None if r.doc_id is None else r.doc_id - shift, r.text) for r in left.collect())
        assert got[None, "a b c d e f g h"] == 1 and got[6, "own words here"] == 1
        assert sum(n for (_, t), n in got.items() if t == "x y z x y z u") == 1
        assert got[None, None] == 1 and got[None, ""] == 1 and sum(got.values()) == 5
    assert (5, "x y z x y z u") in {(r.doc_id, r.text) for r in near_dedup.drop_near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(0)
    m = near_dedup._multipliers()
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sig = {}
    for share in (0.0, 0.5, 0.8):
        n = int(900 * 2 * share / (1 + share))
        b = np.concatenate([a[:n], rng.integers(0, 2**63, 900 - n, dtype=np.uint64)])
        x, y = (near_dedup.signature(np.unique(s), m)[0].view(np.uint64) for s in (a, b))
        sig[share] = near_dedup._estimates(x[None], y[None])[0, 0]
    assert all(abs(e - s) < 0.15 for s, e in sig.items())


def test_empty_table(spark):
    assert near_dedup.near_duplicates(no_docs(spark)).collect() == []
    assert near_dedup.drop_near_duplicates(no_docs(spark)).columns == no_docs(spark).columns


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(50, 51)]])
def test_components(spark, links):
    got = {r.node: r.comp for r in graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    low = {x: x for pair in links for x in pair}
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert got == low


def _vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for c in range(6):
            center = rng.normal(size=20)
            for k in range(rng.integers(1, 9)):
                v = center + rng.normal(size=20) * rng.choice([0.02, 0.12, 0.2])
                rows.append((len(rows), [float(x) for x in np.float32(v)], label))
    same = rows[0][1]
    rows += [(100, same, 0), (101, same, 0), (101, same, 0), (102, [2 * x for x in same], 0), (103, same, 1), (104, same, None),
             (105, None, 0), (106, [0.0] * 20, 0), (107, [1.0, None] * 10, 0), (108, [float("nan")] * 20, 0),
             (109, [float("inf")] + [1.0] * 19, 0), (110, [], 0), (111, [1.0, 1.0], 0), (112, [1.0, 1.01], 0), (113, [1.0], 0),
             (None, same, 0)]
    return rows


def test_vectors_equal_brute_force(spark):
    rows = _vectors()
    ddl = "vec_id long, embedding array<float>, label int, cid long, dim int, copies long, strip long"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], ddl)
    for tile in (512, 3):
        got = embedding_dedup.near_duplicate_vectors(df, tile=tile).collect()
        ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(
            x is not None and np.isfinite(x) for x in v) and any(v)]
        vec = {i: np.array(np.float32(rows[i][1]), float) for i in ok}
        linked = {(a, b) for a in ok for b in ok if a != b and rows[a][2] == rows[b][2] and len(vec[a]) == len(vec[b])
                  and vec[a] @ vec[b] / np.sqrt((vec[a] @ vec[a]) * (vec[b] @ vec[b])) >= 0.98}
        low = list(range(len(rows)))
        for _ in rows:
            for a, b in linked:
                low[a] = low[b] = min(low[a], low[b])
        names = {}
        for i, (k, *_) in enumerate(rows):
            if k is not None:
                names[low[i]] = min(k, names.get(low[i], k))
        want = [(k, sum(a == i for a, _ in linked), names.get(low[i])) for i, (k, *_) in enumerate(rows)]
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_no_pair_is_given_up_that_can_reach_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(80, 40)) * np.linspace(3, 0.1, 40)
    b = a + rng.normal(size=a.shape) * 0.08
    a, b = embedding_dedup._unit(a), embedding_dedup._unit(b)
    i, j = embedding_dedup.possible_pairs(a, b, 0.98, False)
    assert set(zip(*np.nonzero(a @ b.T >= 0.98), strict=True)) <= set(zip(i, j, strict=True))


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicate_vectors(empty).collect() == []
