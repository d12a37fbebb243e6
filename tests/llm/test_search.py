"""Nearest neighbours, prefix tries and ranked search against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import curve_search, lexical_search, prefix_trie
from tessera.llm.running import running_sums

from frames import awkward_docs, no_docs, words

# ------------------------------------------------------------------ nearest neighbours

VECTORS = "vec_id long, embedding array<double>, label int, members string, low long, h string, cid long, dim string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "m", 2, "h", 3, "d") for i, v in rows], VECTORS)


def nearest(rows, every, k):
    ok = [(n, i, v) for n, (i, v) in enumerate(rows)
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, q, x in ok:
        if q % every:
            continue
        found = sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(x, y, strict=True))), i)
                       for m, i, y in ok if m != n and len(y) == len(x))[:k]
        out += [(q, r, i, d) for r, (d, i) in enumerate(found, 1)]
    return sorted(out)


def answers(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], pytest.approx(r["score"], rel=1e-12)) for r in df.collect())


def test_hilbert_keys_step_to_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = curve_search.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        along = cells[np.argsort(keys)]
        assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_nearest_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).round(1).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0] * 6) for i in range(40)]                       # a third of the rows: one vector
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (204, [float("nan")] * 6),
             (205, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (20, rows[20][1]), (30, [9.0] * 6),
             (210, [1.0, 2.0]), (220, [1.0, 2.5]), (230, [-1.0, 2.0]), (240, [5.0])]
    df = vector_frame(spark, rows).repartition(5)
    for curves in (1, 3):
        got = curve_search.nearest_neighbours(df, lambda key: key % 10 == 0, k=10, curves=curves)
        assert answers(got) == nearest(rows, 10, 10)
    assert answers(curve_search.nearest_neighbours(df, lambda key: key % 7 == 0, k=3)) == nearest(rows, 7, 3)


def test_no_vectors_no_queries(spark):
    assert curve_search.op11(vector_frame(spark, [])).collect() == []
    assert curve_search.op11(vector_frame(spark, [(1, [1.0]), (2, [2.0])])).collect() == []
    assert curve_search.op11(vector_frame(spark, [(100, [1.0])])).collect() == []


def test_windows_find_most_where_few_directions_matter(spark, monkeypatch):
    """Five directions in 24 dimensions: windows alone reach a recall of 0.9, with the completion it is 1."""
    monkeypatch.setattr(curve_search, "BLOCK", 128)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 5)) @ rng.standard_normal((5, 24)) + 0.01 * rng.standard_normal((4000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {(q, i) for q, _, i, _ in nearest(rows, 100, 10)}
    recall = {}
    for complete in (False, True):
        got = curve_search.nearest_neighbours(df, lambda key: key % 100 == 0, complete=complete)
        recall[complete] = len(want & {(r["query_id"], r["vec_id"]) for r in got.collect()}) / len(want)
    assert recall[False] >= 0.9 and recall[True] == 1


def test_distances_of_large_offsets_are_exact(spark):
    """Products lose digits far from the origin; the completion must not lose neighbours for it."""
    rng = np.random.default_rng(6)
    rows = [(i, (1e4 + rng.standard_normal(8)).tolist()) for i in range(700)]
    got = curve_search.op11(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert answers(got) == nearest(rows, 100, 10)


# ------------------------------------------------------------------ prefix tries

def trie(rows):
    """Plain Python over rebuilt conversations."""
    stored = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            stored[conv].append((turn is not None, turn or 0, role or "", text or ""))
    stored = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in stored.items()}
    rebuilt = {}
    for c, turns in stored.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = stored.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words_in = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(n) == len(node) + 1 for n in below),
                    sum(not any(m[:-1] == n for m in members if m) for n in below),
                    sum((len(members[n]) - 1) * words_in(n[-1][1]) for n in below if n),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def trie_rows(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: (r[1], r[0]))


CONVERSATIONS = "conv_id long, turn long, role string, text string, rep long, depth string, base long, k0 string, words string"


def conversation_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "k", "w") for r in rows], CONVERSATIONS)


def awkward_conversations():
    rng = random.Random(4)
    heads = [[("user", "hello  there\n"), ("bot", "a b c"), ("user", "")], [("user", "hello  there\n"), ("bot", "")]]
    rows = []
    for c in [*range(0, 45), 63, -7, -20, 10**12]:  # 60 isn't there
        said = rng.choice(heads) + [(rng.choice(["user", "bot"]), rng.choice(["x y", "z", "", None])) for _ in range(rng.randint(0, 4))]
        rows += [(c, t if t else None, role, text) for t, (role, text) in enumerate(said[:rng.randint(1, 7)])]
    rows += [(5, 100, None, None), (5, 101, None, None), (None, 1, "user", "lost"), (None, None, None, None),
             (7, 200, "user", "again"), (7, 200, "user", "again")]
    rows += [(25, 10 + t, "user", f"turn {t % 3}") for t in range(120)]  # a third of all rows
    return rows


def test_trie_of_awkward_conversations(spark):
    rows = awkward_conversations()
    for order in (rows, rows[::-1]):
        assert trie_rows(prefix_trie.op12(conversation_frame(spark, order).repartition(6))) == trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.op12(conversation_frame(spark, [])).collect() == []
    assert prefix_trie.op12(conversation_frame(spark, [(None, 1, "user", "x")])).collect() == []


def test_colliding_hashes_are_noticed(spark, monkeypatch):
    """Turns hashed by their length alone: the texts tell, the next hash is taken."""
    from pyspark.sql import functions as F
    true, rows = prefix_trie.turn_table, awkward_conversations()
    weak = lambda turns, salt: true(turns, salt) if salt else true(turns, salt).withColumns(
        {"h1": F.length("text").cast("long"), "h2": F.lit(1).cast("long")})
    monkeypatch.setattr(prefix_trie, "turn_table", weak)
    assert trie_rows(prefix_trie.op12(conversation_frame(spark, rows))) == trie(rows)


def test_long_lists_of_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    rows = [(c, 0, "user", "same") for c in range(0, 400, 20)] + [(c, 0, "user", "same") for c in range(1, 300)]
    assert trie_rows(prefix_trie.op12(conversation_frame(spark, rows))) == trie(rows)


def test_running_sums_over_a_key_in_many_tasks(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.randint(0, 9)) for t in range(3000)] + [(k, t, rng.randint(0, 9)) for k in range(2, 40) for t in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, t long, v long").repartition(7)
    sums, want = defaultdict(int), {}
    for k, t, v in sorted(rows):
        sums[k] += v
        want[k, t] = sums[k]
    got = running_sums(df, ["k"], ["t"], ["v"], "test-sums")
    assert {(r["k"], r["t"]): r["v_sum"] for r in got.collect()} == want


# ------------------------------------------------------------------ ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, top=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counted:
            m = 75 + 25 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


def test_ranks_of_awkward_documents(spark):
    docs, rows = awkward_docs(spark, long_words=4000)
    rng = random.Random(2)
    items = [(n, " ".join(rng.choices(rows[0][1].split(), k=12) + words(rng, 3))) for n in range(8)]
    items += [(8, None), (9, ""), (10, "Ünïcode TEXT ünïcode"), (None, "One two"), (11, rows[0][1]), (11, rows[0][1]), (12, "zzzz")]
    given = spark.createDataFrame([(i, t, 1, "d") for i, t in items], "item_id long, text string, rank int, doc_id string")
    plain = [(i, t) for i, t, _, _ in rows]
    for block_terms in (lexical_search.BLOCK_TERMS, 30):
        got = lexical_search.rank_documents(docs, given, block_terms=block_terms)
        assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()) == ranked(plain, items)


def test_no_documents_no_items(spark):
    docs, _ = awkward_docs(spark, long_words=10)
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical_search.op13(docs, none).collect() == []
    assert lexical_search.op13(no_docs(spark), some).collect() == []


def test_slices_and_small_accumulators_change_nothing(spark, monkeypatch):
    docs, rows = awkward_docs(spark, long_words=3000)
    items = [(1, rows[0][1]), (2, "one two words lines")]
    given = spark.createDataFrame(items, "item_id long, text string")
    want = ranked([(i, t) for i, t, _, _ in rows], items)
    assert b"".join(b" ".join(x) + b" " for x in lexical_search.text_terms("Ab,c 9\x7fé".encode())).split() == [b"ab", b"c", b"9", "é".encode()]
    monkeypatch.setattr(lexical_search, "CELLS", 200)
    monkeypatch.setattr(lexical_search, "SLICE", 64)
    got = lexical_search.op13(docs, given)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()) == want


def test_shared_sums_equal_plain_ones():
    rng = random.Random(9)
    common = [f"c{i}" for i in range(30)]
    items = [Counter(rng.sample(common, 20) + rng.choices(common, k=5) + [f"own{n}"] * rng.randint(1, 3)) for n in range(60)]
    shared = lexical_search.Shared(items)
    values = {t: np.array([rng.randint(0, 10**12) for _ in range(5)]) for t in shared.atom_of}
    acc = np.zeros((shared.n_nodes(), 5), np.int64)
    for t, atom in shared.atom_of.items():
        acc[atom] += values[t]
    for counts, got in zip(items, shared.scores(acc), strict=True):
        assert (got == sum(values[t] * n for t, n in counts.items())).all()
    assert shared.n_additions() < sum(map(len, items)) * 0.8
