import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from frames import awkward_docs, no_docs

from tessera.llm import mixing, packing, sharding, token_store
from tessera.llm.tokens import PieceEncoder, default_vocabulary, segments


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder.of(default_vocabulary())


def ids_of(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_pieces_encode_like_whole_texts(encoder):
    rng = random.Random(6)
    alphabet = ["a", "b ", "  ", "\n", "\n\n", " \n", "\t", " ", "é", "'s", "'ll ", "12", "!", "!! ", " ", "\x85", "\x1c",
                "<|endoftext|>", "…", " x", "日本", "\r\n", " 's", "​", "﻿", ",", ".", "_", "\0"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(2000)] + [None, "", "a" * 50_000, "x.y, z._,"]
    want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for text, ids, w in zip(texts, encoder.encode(texts), want, strict=True):
        assert ids == b"".join(i.to_bytes(4, "little") for i in w.ids), repr(text)


def test_long_texts_are_encoded_in_segments(encoder, monkeypatch):
    text = "some words, and more. " * 400 + "\n  end"
    assert "".join(segments(text, 100)) == text and len(list(segments(text, 100))) > 50
    monkeypatch.setattr("tessera.llm.tokens.SEGMENT", 1000)
    assert next(iter(encoder.encode([text]))) == b"".join(i.to_bytes(4, "little") for i in ids_of(encoder, text)[:-1])


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("tessera.llm.tokens.CACHE_PIECES", 5)
    own = PieceEncoder(default_vocabulary())
    texts = [f"word{i} word{i + 1} again" for i in range(200)]
    want = [b"".join(i.to_bytes(4, "little") for i in ids_of(own, t)[:-1]) for t in texts]
    assert list(own.encode(texts)) == want


def test_words_are_learned_without_their_signs(monkeypatch):
    """Signs after a word make no new piece, and a full cache keeps the pieces at hand."""
    own = PieceEncoder(default_vocabulary())
    texts = ["one word%%% two word&& word! café| café» (word) привет: it's"] * 3
    assert list(own.encode(texts)) == [b"".join(i.to_bytes(4, "little") for i in ids_of(own, t)[:-1]) for t in texts]
    assert {" word", "%%%", "&&", "!", " café", "|", " привет", ":", " it", "'s"} <= set(own.cache)
    assert not {" word%%%", " word&&", " café|"} & set(own.cache)
    monkeypatch.setattr("tessera.llm.tokens.CACHE_PIECES", len(own.cache) + 1)
    list(own.encode(["new words and word%%%"]))
    assert set(own.cache) == {"new", " words", " and", " word", "%%%"}


def test_new_pieces_share_a_call_of_the_tokenizer():
    own, sizes = PieceEncoder(default_vocabulary()), []

    class Counted:
        def encode_batch_fast(self, texts, add_special_tokens):
            sizes.append(len(texts))
            return inner.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    inner, own.tokenizer = own.tokenizer, Counted()
    text = " ".join(f"w{i}\nx{i}" for i in range(2000))
    assert next(iter(own.encode([text]))) == b"".join(i.to_bytes(4, "little") for i in inner.encode(text).ids)
    assert len(own.cache) == 4000 and sum(sizes) < 30


@pytest.mark.parametrize("segment", [1, 7, 60, 4 << 20])
def test_groups_of_any_size_give_the_same_ids(encoder, monkeypatch, segment):
    rng = random.Random(segment)
    signs = ["a", "B", "é", "×", "÷", "ß", "ж", "日", "҂", "1", "²", " ", " ", "\n", "\t", "\u2003", "\u3000", "\u205f", "\u1680", "\x85",
             "\xa0", "\x1c", "'", "'re", ",", "%", "_", "“", "”", "\u2028", "😀", "<|endoftext|>", "\0"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 25))) for _ in range(3000)]
    texts[5] = texts[6] = texts[-1] = None
    monkeypatch.setattr("tessera.llm.tokens.SEGMENT", segment)
    column = pa.array(["ahead", *texts]).slice(1)
    ids, counts = (np.concatenate(x) for x in zip(*encoder.groups(column), strict=True))
    want = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for own in want for i in own]


def test_copies_go_on_from_batch_to_batch():
    keys, last, got = [None, None, None, 0, 0, 1, 2, 2, 2, 2, 3], None, []
    for at in range(0, len(keys), 3):
        copies, last = token_store._copies(pa.array(keys[at:at + 3], pa.int64()), last)
        got += copies.tolist()
    assert got == [0, 1, 2, 0, 1, 0, 0, 1, 2, 3, 0]


def test_store_round_trip(spark, encoder, tmp_path):
    docs, rows = awkward_docs(spark, long_words=3000)
    folder = token_store.write_store(docs, f"file://{tmp_path}/store", block_ids=500, index_keys=8)
    keys = Counter(i for i, *_ in rows)
    wanted = spark.createDataFrame([(i, c) for i, n in keys.items() for c in range(n)] + [(999, 0), (3, 7)], "doc_id long, copy long")
    got = token_store.read_digest(wanted, folder).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].encode()) if r[1] is not None else -1))
    at, want = 0, []
    for i, t, *_ in order:
        ids = ids_of(encoder, t)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    one = token_store.get_ids(spark.createDataFrame([(9, 0)], "doc_id long, copy long"), folder).collect()
    assert [bytes(r.ids) for r in one] == [b"".join(i.to_bytes(4, "little") for i in ids_of(encoder, "two words"))]


def test_store_of_nothing(spark, tmp_path):
    folder = token_store.write_store(no_docs(spark), f"file://{tmp_path}/store")
    keys = spark.createDataFrame([(1, 0)], "doc_id long, copy long")
    assert token_store.read_digest(keys, folder).collect() == [] and token_store.op2(no_docs(spark)).collect() == []


def test_hash_function_is_minimal_and_perfect():
    import numpy as np

    h = np.unique(np.random.default_rng(0).integers(0, 2**63, 20_000, dtype=np.uint64))
    sizes, bits, slots = token_store.build_function(np.append(h, h[:2]))  # two hashes occur twice
    assert sorted(slots[slots >= 0]) == list(range(len(h) - 2)) and (slots < 0).sum() == 4
    ranks = np.cumsum(bits) - bits
    found = token_store.find_slots(sizes, bits, ranks, h[2:])
    assert np.array_equal(found, slots[2:len(h)])


def test_packing_round_trip(spark, encoder):
    docs, rows = awkward_docs(spark, long_words=2500)
    got = packing.piece_rows(packing.pack_documents(docs)).collect()
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(ids_of(encoder, t))
    pieces, sequences = Counter(), defaultdict(list)
    for r in got:
        ids = [int.from_bytes(bytes(r.ids[k:k + 4]), "little") for k in range(0, len(r.ids), 4)]
        assert len(ids) == r.length and crc(ids) == r.ids_crc32
        assert any(own[r.start:r.start + r.length] == ids and len(own) == r.doc_tokens for own in texts[r.doc_id])
        pieces[(r.doc_id, r.start, r.length)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(len(x) for own in texts.values() for x in own)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    assert packing.pack_documents(no_docs(spark)).collect() == []


def test_packing_holds_no_second_copy_of_a_batch(encoder, monkeypatch):
    """The texts of a batch are read where they lie, and remainders lie in the chunk's one array."""
    monkeypatch.setattr("tessera.llm.tokens.SEGMENT", 1 << 16)
    words = [f"word{i}" for i in range(500)]
    rng = random.Random(3)
    texts = [None if i % 50 == 7 else " ".join(rng.choices(words, k=rng.randint(0, 1500))) for i in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(599)], pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    list(encoder.encode([" ".join(words)]))  # all words are in the cache
    pieces, most, before = Counter(), 0, pa.total_allocated_bytes()
    for parts, ids in packing._pack([batch, batch], encoder, 64, 100):
        assert len(ids) == 4 * sum(p[2] for p in parts) <= 256
        for doc, start, length, total, offset in parts:
            pieces[doc, start, length, total, zlib.crc32(ids[4 * offset:4 * (offset + length)])] += 1
        most = max(most, pa.total_allocated_bytes() - before)
    want = Counter()
    for doc, text in zip([None, *range(599)], texts, strict=True):
        own = ids_of(encoder, text)
        for at in range(0, len(own), 64):
            want[doc, at, len(own[at:at + 64]), len(own), crc(own[at:at + 64])] += 2
    assert pieces == want
    assert most < batch.nbytes / 4


def test_best_fit_decreasing_takes_the_tightest_window():
    rng = random.Random(2)
    for length in (8, 1000, 1024):
        lengths = [rng.randint(1, length) for _ in range(400)]
        room = []
        for n in sorted(lengths, reverse=True):
            fit = min((r for r in room if r >= n), default=None)
            if fit is not None:
                room.remove(fit)
            room.append((fit if fit is not None else length) - n)
        windows = packing.best_fit_decreasing(lengths, length)
        assert sorted(i for w in windows for i in w) == list(range(400))
        assert sorted(length - sum(lengths[i] for i in w) for w in windows) == sorted(room)


def test_shards_equal_brute_force(spark):
    docs, rows = awkward_docs(spark)
    got = sharding.shard_documents(docs, 4, range_rows=7).collect()
    data = lambda t: (t or "").encode()
    want = Counter((i, len(data(t)) + 16, zlib.crc32(data(t))) for i, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    place = lambda i, c, s: (i is not None, i or 0, c, s)
    order = sorted(want.elements(), key=lambda x: place(x[0], x[2], x[1]))
    total, at, shards = sum(x[1] for x in order), 0, []
    for _, size, _ in order:
        shards.append((2 * at + size) * 4 // (2 * total))
        at += size
    by_place = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [place(r.doc_id, r.text_crc32, r["size"]) for r in by_place] == [place(i, c, s) for i, s, c in order]
    assert [r.shard for r in by_place] == shards
    for shard in set(shards):
        assert [r.slot for r in by_place if r.shard == shard] == list(range(shards.count(shard)))
    assert sharding.op5(no_docs(spark)).collect() == []


def fill(sizes, weights=(5, 2, 1), most=3):
    """Targets by literal redistribution."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, fixed, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return target
        share = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * share > most * sizes[s]]
        if not over:
            return target | {s: w[s] * share for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            fixed.add(s)


def test_mix_equals_literal_redistribution(spark):
    docs, rows = awkward_docs(spark)
    got = mixing.mix_documents(docs).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want = fill(sizes)
    assert {r.source_size for r in got} <= set(sizes.values())
    for _, t, _, s in rows:
        assert any(abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] for r in got)
    assert sorted(r["size"] for r in got) == sorted(len((t or "").split()) for _, t, *_ in rows)
    assert all(0 <= r.times <= 3 for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_documents(docs.repartition(1)).collect()), key=repr)


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 30), rng.choice(["big"] * 8 + ["mid", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = Counter(), {}
    for r in mixing.mix_documents(docs).collect():
        taken[r.source_size] += r["size"] * r.times
        target[r.source_size] = r.target
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)
    again = mixing.repeat_documents(docs)
    assert again.columns == docs.columns
    words = Counter()
    for r in again.collect():
        words[r.source] += len(r.text.split())
    assert sorted(words.values()) == sorted(taken.values())


def test_repeated_rows_are_drawn_one_by_one(spark):
    rows = [(1, "a b c d", "x")] * 900 + [(i, "a b c d", "x") for i in range(2, 102)] + [(1000 + i, "w " * 4, "y") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = Counter()
    for r in mixing.mix_documents(docs).collect():
        taken[r.target] += r["size"] * r.times
    assert all(abs(n - t) < 0.1 * t for t, n in taken.items())


def test_nothing_to_mix(spark):
    assert mixing.op10(no_docs(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r["size"], r.taken, r.target) for r in mixing.op10(blank).collect()] == [(0, 0, 0.0)] * 2
