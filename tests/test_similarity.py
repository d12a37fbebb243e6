import hashlib
import random
from itertools import combinations

import numpy as np
import pytest

from tessera.functions import hashing as h
from tessera.operators import exact, quality
from tessera.operators import similarity as sim
from tessera.plans.near_duplicates import LshParams, analyze_quality, exact_key_pairs, find_near_duplicates

K = 9
WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho "
         "sigma tau upsilon phi chi psi omega été naïve façade smörgåsbord 😀 🚀").split()


def _py_shingles(text, k=K):
    w = h.shingle_weights(k)
    return sorted({sum(ord(c) * wj for c, wj in zip(text[i:i + k], w)) % h.SHINGLE_PRIME
                   for i in range(len(text) - k + 1)})


def _py_signature(shingles, params):
    return [min(((a * x + b) % h.MINHASH_PRIME) % h.MINHASH_RANGE for x in shingles) for a, b in params]


def _jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b)


def _corpus(seed=3, n_base=25):
    rng = random.Random(seed)
    docs, next_id = [], 1
    for _ in range(n_base):
        words = [rng.choice(WORDS) for _ in range(rng.randint(40, 90))]
        base = " ".join(words)
        docs.append((next_id, base)); next_id += 1
        for _ in range(rng.randint(0, 3)):       # exact copies
            docs.append((next_id, base)); next_id += 1
        for _ in range(rng.randint(0, 3)):       # near copies
            w2 = list(words)
            for _ in range(rng.randint(1, 4)):
                w2[rng.randrange(len(w2))] = rng.choice(WORDS)
            docs.append((next_id, " ".join(w2))); next_id += 1
    docs += [(next_id, "short"), (next_id + 1, "12345678"), (next_id + 2, "123456789"), (next_id + 3, "")]
    return docs


def test_shingle_hash_matches_definition_and_counts_code_points():
    w = np.array(h.shingle_weights(K), dtype=np.int64)
    for text in ["naïve façade 😀🚀 smörgåsbord", "abcdefghi", "x" * 30]:
        assert h.text_shingle_hashes(text, w).tolist() == _py_shingles(text)
    assert h.text_shingle_hashes("😀" * 9, w).size == 1
    assert h.text_shingle_hashes("12345678", w).size == 0


def test_hash_family_is_seeded_distinct_and_bounded():
    p = h.hash_family(143, 1)
    assert p == h.hash_family(143, 1) and p != h.hash_family(143, 2)
    assert len(set(p)) == 143
    assert all(1 <= a <= h.A_MAX and 0 <= b <= h.B_MAX for a, b in p)
    assert all(a * (2 ** 32 - 1) + b < 2 ** 63 for a, b in p)


def test_minhash_kernel_matches_definition():
    params = h.hash_family(20, 5)
    a = np.array([x for x, _ in params], dtype=np.int64)
    b = np.array([y for _, y in params], dtype=np.int64)
    rng = np.random.default_rng(1)
    for size in (1, 7, 300, 1000):
        x = np.unique(rng.integers(0, h.SHINGLE_PRIME, size))
        assert h.minhash_block(x, a, b).tolist() == _py_signature(x.tolist(), params)


def test_length_filter_boundary_and_nulls(spark):
    docs = spark.createDataFrame([(1, "12345678"), (2, "123456789"), (3, ""), (4, None), (None, "abcdefghijk")],
                                 "doc_id long, text string")
    sh = {r.doc_id: r.shingles for r in sim.shingles(docs, K).collect()}
    assert list(sh) == [2] and len(sh[2]) == 1


def test_pipeline_matches_brute_force(spark):
    docs = _corpus()
    params = LshParams(shingle_size=K, bands=6, rows=4, seed=1, threshold=0.8)
    nd = find_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), params)

    hp = params.hash_params()
    shingles = {i: _py_shingles(t) for i, t in docs if len(t) >= K}
    sigs = {i: _py_signature(s, hp) for i, s in shingles.items()}
    got_sh = {r.doc_id: r.shingles for r in nd.shingles().collect()}
    assert got_sh == shingles
    assert {r.doc_id: r.signature for r in nd.signatures.collect()} == sigs

    bands = {}
    for i, s in sigs.items():
        for band in range(params.bands):
            bands.setdefault((band, tuple(s[band * params.rows:(band + 1) * params.rows])), []).append(i)
    cand = {tuple(sorted(p)) for members in bands.values() for p in combinations(members, 2)}
    got_cand = {(r.first, r.second) for r in nd.candidate_pairs().collect()}
    assert got_cand == cand
    assert all(a < b for a, b in got_cand)

    sims = {r.first * 10 ** 6 + r.second: r.similarity for r in nd.pair_similarity().collect()}
    for a, b in cand:
        assert sims[a * 10 ** 6 + b] == pytest.approx(_jaccard(shingles[a], shingles[b]), abs=0, rel=1e-15)
    similar = {(a, b) for a, b in cand if _jaccard(shingles[a], shingles[b]) >= params.threshold}
    assert {(r.first, r.second) for r in nd.similar_pairs().collect()} == similar

    exact_all = {(a, b) for a, b in combinations(sorted(shingles), 2)
                 if _jaccard(shingles[a], shingles[b]) >= params.threshold}
    got_exact = {(r.first, r.second) for r in nd.expand(exact_key_pairs(nd), {"similarity": 1.0}).collect()}
    assert got_exact == exact_all
    assert similar <= exact_all


def test_identical_docs_and_numeric_ids(spark):
    text = "the same text repeated for everyone"
    docs = spark.createDataFrame([(10, text), (9, text), (11, text + "!")], "doc_id long, text string")
    nd = find_near_duplicates(docs, LshParams(threshold=0.85))
    rows = nd.similar_pairs().orderBy("first", "second").collect()
    assert [(r.first, r.second) for r in rows][0] == (9, 10)
    assert rows[0].similarity == 1.0
    assert all(r.first < r.second for r in rows)
    assert dict(nd.similar_pairs().dtypes)["first"] == "bigint"
    lookup = sim.similar_to(nd.similar_pairs(), spark.createDataFrame([(9,)], "doc_id long"))
    assert {r.similar_id for r in lookup.collect()} >= {10}


def test_no_candidates_gives_null_rates(spark):
    docs = spark.createDataFrame([(1, "aaaaaaaaaaaa"), (2, "bbbbbbbbbbbb"), (3, "cccccccccccc")],
                                 "doc_id long, text string")
    nd = find_near_duplicates(docs)
    assert nd.candidate_pairs().count() == 0
    report = analyze_quality(nd, fraction=0.999999, rounds=2)
    fp = report.fp.orderBy("round").collect()
    assert [r.candidates for r in fp] == [0, 0] and all(r.fp_rate is None for r in fp)
    fn = report.fn.collect()
    assert all(r.false_negatives == 0 and r.fn_rate == 0.0 for r in fn)


def test_quality_matches_brute_force(spark):
    docs = _corpus(seed=11, n_base=30)
    params = LshParams(shingle_size=K, bands=3, rows=6, seed=2, threshold=0.8)
    nd = find_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), params)
    fraction, rounds, seed = 0.6, 3, 5
    report = analyze_quality(nd, fraction, rounds, seed)

    shingles = {i: _py_shingles(t) for i, t in docs if len(t) >= K}
    cand = {(r.first, r.second) for r in nd.candidate_pairs().collect()}
    got_fp = {r["round"]: r for r in report.fp.collect()}
    got_fn = {r["round"]: r for r in report.fn.collect()}
    got_fn_pairs = {(r["round"], r.first, r.second) for r in report.fn_pairs.collect()}
    exp_fn_pairs = set()
    for rnd in range(rounds):
        def unit(i):
            digest = hashlib.md5(f"{i}:{seed + rnd}".encode()).hexdigest()
            return int(digest[:8], 16) / 2 ** 32
        sample = sorted(i for i in shingles if unit(i) < fraction)
        pairs = list(combinations(sample, 2))
        c = [p for p in pairs if p in cand]
        v = [p for p in c if _jaccard(shingles[p[0]], shingles[p[1]]) >= params.threshold]
        fn = [p for p in pairs if p not in cand and _jaccard(shingles[p[0]], shingles[p[1]]) >= params.threshold]
        exp_fn_pairs |= {(rnd, a, b) for a, b in fn}
        assert got_fp[rnd].candidates == len(c) and got_fp[rnd].verified == len(v)
        assert got_fp[rnd].fp_rate == pytest.approx((len(c) - len(v)) / len(c)) if c else got_fp[rnd].fp_rate is None
        n = len(sample)
        assert (got_fn[rnd].n_docs, got_fn[rnd].false_negatives) == (n, len(fn))
        assert got_fn[rnd].fn_rate == pytest.approx(len(fn) / (n * (n - 1) // 2 - len(c)))
    assert got_fn_pairs == exp_fn_pairs
    summary = report.summary.first()
    assert summary.rounds == rounds and summary.fraction == fraction


def test_sample_is_seeded_bernoulli(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    s = quality.doc_sample(ids, 0.1, seed=1, rounds=2)
    counts = {r["round"]: r["count"] for r in s.groupBy("round").count().collect()}
    assert all(1800 < c < 2200 for c in counts.values())
    again = quality.doc_sample(ids.repartition(7), 0.1, seed=1, rounds=2)
    assert s.exceptAll(again).count() == 0 and again.exceptAll(s).count() == 0


def test_exact_join_prefix_filter_is_exact(spark):
    rng = random.Random(4)
    base = [rng.sample(range(200), 40) for _ in range(6)]
    sets = []
    for i in range(60):
        s = set(base[i % 6])
        for _ in range(rng.randint(0, 8)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(1000))
        sets.append((i, sorted(s)))
    df = spark.createDataFrame(sets, "doc_id long, shingles array<long>")
    for t in (0.5, 0.8, 0.85, 1.0):
        got = {(r.first, r.second) for r in exact.exact_similar_pairs(df, t).collect()}
        want = {(a, b) for (a, x), (b, y) in combinations(sets, 2) if _jaccard(x, y) >= t}
        assert got == want


def test_signature_similarity_and_s_curve(spark):
    pairs = spark.createDataFrame([(1, 2)], "first long, second long")
    sigs = spark.createDataFrame([(1, [1, 2, 3, 4]), (2, [1, 9, 3, 8])], "doc_id long, signature array<long>")
    r = sim.signature_similarity(pairs, sigs).first()
    assert (r.matching_rows, r.estimate) == (2, 0.5)
    check = quality.lsh_parameter_check(11, 13)
    assert check["high_ok"] and check["low_ok"]
    assert check["p_high"] == pytest.approx(0.9075, abs=1e-4) and check["p_low"] == pytest.approx(0.0461, abs=1e-4)
    curve = {round(r.s, 2): r.probability for r in quality.lsh_s_curve(spark, 11, 13).collect()}
    assert len(curve) == 100 and curve[0.85] == pytest.approx(check["p_high"])


def test_lsh_recall_and_containment_on_documents(spark):
    """verified ⊆ candidates, verified ⊆ exact, recall close to the S-curve value."""
    from conftest import SF01
    from tessera.plans import catalog

    nd = find_near_duplicates(catalog.documents(spark, SF01))
    cand = {(r.first, r.second) for r in nd.candidate_pairs().collect()}
    similar = {(r.first, r.second) for r in nd.similar_pairs().collect()}
    exact_pairs = {(r.first, r.second) for r in nd.expand(exact_key_pairs(nd), {"similarity": 1.0}).collect()}
    assert similar <= cand and similar <= exact_pairs
    assert len(exact_pairs) == 129            # hash-independent answer at sf0.01
    p_high = quality.lsh_parameter_check(11, 13)["p_high"]
    assert len(similar) / len(exact_pairs) >= p_high - 0.05
    partners = {r.similar_id for r in sim.similar_to_id(nd.similar_pairs(), next(iter(similar))[0]).collect()}
    assert next(iter(similar))[1] in partners


def test_copy_group_pairs_salted_grid_is_exact(spark):
    from tessera.plans.near_duplicates import copy_group_pairs

    rows, next_id = [], 0
    for key, size in (("a", 1), ("b", 2), ("c", 7), ("d", 20)):
        for _ in range(size):
            rows.append((next_id, key))
            next_id += 1
    members = spark.createDataFrame(rows, "doc_id long, copy_key string")
    want = {(k, x, y) for k in "abcd" for x, y in combinations(sorted(i for i, kk in rows if kk == k), 2)}
    for split in (3, 2048):
        got = [(r.copy_key, r.first, r.second) for r in copy_group_pairs(members, split).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_repeated_ids_are_one_document(spark):
    """Rows (1, 1, 2, 3, 3): the text with the smallest copy key stands for an id; no self or double pairs."""
    base = "the quick brown fox jumps over the lazy dog and runs away from all the other animals"
    rows = [(1, base), (1, base + " quickly"), (2, base), (3, base + "!"), (3, base + "!")]
    params = LshParams(threshold=0.5, bands=20, rows=2)
    nd = find_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params)
    sets = {r.doc_id: set(r.shingles) for r in nd.shingles().collect()}
    assert sorted(sets) == [1, 2, 3] and nd.signatures.count() == 3
    want = sorted((a, b, len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a in sets for b in sets if a < b)
    assert sorted((r.first, r.second, r.similarity) for r in nd.similar_pairs().collect()) == want
    exact = nd.expand(exact_key_pairs(nd), {"similarity": 1.0})
    assert sorted((r.first, r.second, r.similarity) for r in exact.collect()) == want


def test_threshold_is_inclusive_at_17_of_20(spark):
    sets = spark.createDataFrame([(1, list(range(20))), (2, list(range(17)))], "doc_id long, shingles array<long>")
    pairs = spark.createDataFrame([(1, 2)], "first long, second long")
    assert [r.similarity for r in sim.similar_pairs(pairs, sets, 0.85).collect()] == [0.85]


def test_pair_counts_beyond_bigint_halves(spark):
    m = 4_000_000_000
    keys = spark.createDataFrame([(0, "a", m)], "round int, copy_key string, m long")
    none = spark.createDataFrame([], "first string, second string")
    rounds = spark.createDataFrame([(0,)], "round int")
    fp = quality.false_positive_rate(rounds, keys, none, none).first()
    fn = quality.false_negative_rate(rounds, keys, none, none).first()
    assert fp.candidates == fp.verified == m * (m - 1) // 2 and fp.fp_rate == 0.0
    assert fn.n_docs == m and fn.candidates == m * (m - 1) // 2 and fn.fn_rate is None
