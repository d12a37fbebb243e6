"""The exact join over texts: its rows grow with the corpus, not with its square."""

import random

import numpy as np
import pytest

from tessera.functions import hashing
from tessera.operators import exact
from tessera.sources import storage

K = 9


def sets_of(texts):
    weights = np.array(hashing.shingle_weights(K), dtype=np.int64)
    return {i: set(hashing.text_shingle_hashes(t, weights).tolist()) for i, t in texts.items()}


def brute_force(texts, threshold):
    sets = {i: s for i, s in sets_of(texts).items() if s}
    out = {}
    for i in sets:
        for j in sets:
            if i < j:
                common = len(sets[i] & sets[j])
                similarity = common / (len(sets[i]) + len(sets[j]) - common)
                if similarity >= threshold:
                    out[i, j] = similarity
    return out


def corpus(rng, families=14, most=400):
    texts = {}
    for family in range(families):
        base = [rng.choice("abcdefg ") for _ in range(rng.choice([9, 12, 30, 90, rng.randint(100, most)]))]
        for copy in range(6):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                at = rng.randrange(len(text))
                text[at:at + rng.choice([0, 1, 2])] = rng.choices("abcdefg ", k=rng.choice([0, 1, 3]))
            if rng.random() < 0.2:
                text += rng.choices("abcdefg ", k=len(text) // 9)
            texts[10 * family + copy] = "".join(text)
    return texts


@pytest.mark.parametrize("threshold", [0.4, 0.85, 1.0])
def test_exact_join_of_texts_equals_brute_force(spark, threshold):
    texts = corpus(random.Random(int(100 * threshold)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    ids = docs.filter("doc_id % 10 <> 5").select("doc_id")
    got = exact.exact_similar_texts(docs, threshold, K, ids)
    want = brute_force({i: t for i, t in texts.items() if i % 10 != 5}, threshold)
    assert want and {(r.first, r.second): r.similarity for r in got.collect()} == want
    assert got._tessera_metrics["candidates"] >= len(want)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.85, 0.95])
def test_similar_sets_share_a_kept_part(threshold):
    """The pigeonhole at its edge: the most differing tokens that the threshold allows."""
    rng = random.Random(2)
    for n in [*range(1, 40), 100, 333, 1000]:
        for larger in {n, int(n / threshold)}:
            common = next(c for c in range(n + 1) if c >= threshold * (n + larger - c) - 1e-9)
            tokens = rng.sample(range(1 << 32), n + larger - common)
            y, x = np.array(tokens[:n], np.int64), np.array(tokens[n - common:], np.int64)
            assert len(x) == larger
            parts = lambda s: {(p, below) for found, below in exact.kept_parts(s, threshold) for p in found.tolist()}
            px, py = parts(x), parts(y)
            assert {p for p, below in px} & {p for p, below in py if not below}, (n, larger)


def test_texts_without_a_partner_leave_few_rows(spark, monkeypatch):
    """Texts over few words, none similar to another: hardly anything of them is stored, however full a sketch would be."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(100)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=300))) for i in range(150)], "doc_id long, text string")
    stored = {}

    def kept(df, name="table", metrics=None):
        out = storage.materialize(df, name, metrics)
        stored[name] = out._tessera_rows
        return out
    monkeypatch.setattr(exact, "materialize", kept)
    assert exact.exact_similar_texts(docs, 0.85, K, docs.select("doc_id"))._tessera_rows == 0
    assert sum(stored.values()) < 150, stored  # 150 sets of some 1,400 tokens
