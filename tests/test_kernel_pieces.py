"""The hash kernels hold a piece of a batch at a time, not a batch's sets."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions import hashing

K = 9


def test_kernels_work_on_pieces_of_a_batch(spark):
    texts = [None, "", "short", *["".join(random.Random(i).choices("abcdefgh ", k=k)) for i, k in enumerate([9, 40, 300_000, 5, 900_000] * 3)]]
    column = pa.array(texts, pa.string())
    found = [t for t, in hashing.pieces(column, most=1 << 16)]
    assert [x for t in found for x in t.to_pylist()] == texts
    assert len(found) > 6 and all(len(t) == 1 or t.nbytes <= 1 << 17 for t in found)
    weights = np.array(hashing.shingle_weights(K), dtype=np.int64)
    params = hashing.hash_family(6)
    a, b = (np.array([p[i] for p in params], dtype=np.int64) for i in (0, 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    both = hashing.shingles_with_signature(F.col("text"), K, params)
    got = docs.select("doc_id", hashing.shingle_hashes(F.col("text"), K).alias("s"), both.alias("r"),
                      hashing.text_similarity(F.lit("abcdefghijkl"), F.coalesce("text", F.lit("")), K).alias("j"))
    got = {r.doc_id: r for r in got.withColumn("m", hashing.minhash_signature(F.col("s"), params)).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else hashing.text_shingle_hashes(t, weights)
        signature = None if want is None or not want.size else hashing.minhash_block(want, a, b).tolist()
        want = None if want is None else want.tolist()
        assert (got[i].s, got[i].r.shingles, got[i].r.signature, got[i].m) == (want, want, signature, signature)
        assert got[i].j == 0
