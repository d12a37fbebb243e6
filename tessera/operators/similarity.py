"""Near-duplicate detection: shingles, MinHash, banded LSH and exact verification.

Relations (``id`` is any orderable id column, numeric ids keep their type):

* shingles    ``(id, shingles array<bigint>)`` sorted distinct 32-bit shingle hashes
* signatures  ``(id, signature array<bigint>)`` of length bands * rows
* bands       ``(id, band int, bucket bigint)`` one row per band
* pairs       ``(first, second)`` with ``first < second``, plus ``similarity``

Skew: bucket membership and pair generation stay long-form (one row per
document and band) and pairs come from an equi self-join on ``(band,
bucket)``, which AQE's skew-join splits when one bucket is hot. No bucket is
ever collected into a single array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_family, minhash_signature, shingle_hashes, text_similarity
from tessera.functions.setsim import jaccard, matching_positions
from tessera.functions.sketches import BLOOM_BITS, Bloom
from tessera.operators.cells import listed_similarity
from tessera.operators.joins import ensure_parallelism, known_rows, pairs_within_groups
from tessera.sources.storage import materialize

# Defaults of the job (shingle size, bands, rows per band, seed, threshold).
SHINGLE_SIZE = 9
BANDS = 13
ROWS = 11
SEED = 1
THRESHOLD = 0.85


def doc_length_filter(docs: DataFrame, k: int = SHINGLE_SIZE, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Documents with a non-null id and at least ``k`` characters (>= 1 shingle)."""
    return (docs.select(id_col, text_col)
            .filter(F.col(id_col).isNotNull() & (F.length(text_col) >= k)))


def shingles(docs: DataFrame, k: int = SHINGLE_SIZE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(id, shingles)`` for every document with at least one k-shingle."""
    kept = ensure_parallelism(doc_length_filter(docs, k, id_col, text_col), id_col)
    return kept.select(id_col, shingle_hashes(F.col(text_col), k).alias("shingles"))


def minhash(shingle_sets: DataFrame, params: list[tuple[int, int]] | None = None,
            n_functions: int = BANDS * ROWS, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """``(id, signature)``: per-document MinHash signature (no shuffle)."""
    params = params if params is not None else hash_family(n_functions, seed)
    return shingle_sets.select(id_col, minhash_signature(F.col("shingles"), params).alias("signature"))


def band_slices(signatures: DataFrame, bands: int = BANDS, rows: int = ROWS,
                id_col: str = "doc_id") -> DataFrame:
    """``(id, band, band_rows array<bigint>)``: the signature cut into ``bands`` slices."""
    parts = F.array(*[F.struct(F.lit(i).alias("band"),
                               F.slice("signature", i * rows + 1, rows).alias("band_rows"))
                      for i in range(bands)])
    return signatures.select(id_col, F.inline(parts))


def lsh_bands(signatures: DataFrame, bands: int = BANDS, rows: int = ROWS,
              id_col: str = "doc_id") -> DataFrame:
    """``(id, band, bucket)``: the 64-bit bucket id of every band slice.

    Built from explicit column expressions (one struct per band), so it runs
    inside whole-stage codegen.
    """
    parts = F.array(*[F.struct(F.lit(i).alias("band"),
                               F.xxhash64(F.slice("signature", i * rows + 1, rows)).alias("bucket"))
                      for i in range(bands)])
    return signatures.select(id_col, F.inline(parts))


def buckets(band_rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(band, bucket, id, bucket_size)`` for buckets with more than one member.

    Sizes come from a partial+final count per bucket (a hot bucket collapses
    map-side), then a join back on the bucket key.
    """
    sizes = (band_rows.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("bucket_size"))
             .filter(F.col("bucket_size") > 1))
    return band_rows.join(sizes, ["band", "bucket"]).select("band", "bucket", id_col, "bucket_size")


def candidate_pairs(band_rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(first, second)``: distinct id pairs sharing at least one band bucket.

    The rows of buckets with more than one member are stored once, and the
    largest bucket is observed in that pass. Pairs inside a bucket come from a
    self-join, grid-salted if that size asks for it (a hot bucket is spread
    over many tasks), then one distinct over all bands.
    """
    crowded = materialize(buckets(band_rows.select("band", "bucket", id_col), id_col), "crowded_buckets",
                          {"largest": F.max("bucket_size")})
    largest = int(crowded._tessera_metrics["largest"] or 0)
    return (pairs_within_groups(crowded, ["band", "bucket"], id_col, max_group=largest)
            .select("first", "second").distinct())


def pair_similarity(pairs: DataFrame, shingle_sets: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add the exact Jaccard ``similarity`` of each pair's shingle sets."""
    s1 = shingle_sets.select(F.col(id_col).alias("first"), F.col("shingles").alias("_s1"))
    s2 = shingle_sets.select(F.col(id_col).alias("second"), F.col("shingles").alias("_s2"))
    return (pairs.join(s1, "first").join(s2, "second")
            .select(*pairs.columns, jaccard("_s1", "_s2").alias("similarity")))


def texts_of(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", bits: int = BLOOM_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (same column), and few others.

    A Bloom filter of the ids, of a size that is a parameter, is applied in
    the scan: texts that nobody asked for cross no exchange. Its false hits
    cost work only; every use joins the exact ids later.
    """
    return docs.filter(Bloom.of(ids, id_col, bits).may_hold(id_col))


def text_pair_similarity(pairs: DataFrame, docs: DataFrame, k: int = SHINGLE_SIZE, id_col: str = "doc_id",
                         behind: list[DataFrame] | None = None) -> DataFrame:
    """``pairs`` (``first``, ``second``, ...) with the exact Jaccard ``similarity`` of the two texts' shingle sets.

    Texts travel, an eighth of the size of their sets; the sets are computed
    where both texts are and cross no exchange. To few pairs the texts go pair
    by pair, to more of them cell by cell (:mod:`tessera.operators.cells`);
    stored tables that the result reads go to ``behind``. Every id of
    ``docs`` is there once.
    """
    if not _small(pairs):
        return listed_similarity(pairs, docs, k, id_col, behind=behind)
    ids = (pairs.select(F.col("first").alias(id_col)).unionByName(pairs.select(F.col("second").alias(id_col)))).distinct()
    wanted = texts_of(docs.select(id_col, "text"), ids, id_col)
    if behind is not None:  # read twice
        wanted = materialize(wanted, "pair_texts")
        behind.append(wanted)
    side = lambda c: wanted.select(F.col(id_col).alias(c), F.col("text").alias(f"_{c}"))
    joined = pairs.join(side("first"), "first").join(side("second"), "second")
    # few bytes, much work: as many tasks as there are slots at least
    joined = joined.repartition(joined.sparkSession.sparkContext.defaultParallelism * 2, "second")
    return joined.select(*pairs.columns, text_similarity(F.col("_first"), F.col("_second"), k).alias("similarity"))


SMALL = 50_000  # pairs that texts go to one by one


def _small(pairs: DataFrame) -> bool:
    return (known_rows(pairs) if known_rows(pairs) is not None else SMALL) < SMALL


def size_test(threshold: float, n_first: Column, n_second: Column) -> Column:
    """Whether two sets of these sizes can have a Jaccard of ``threshold``."""
    small, large = F.least(n_first, n_second).cast("double"), F.greatest(n_first, n_second).cast("double")
    return small >= F.lit(float(threshold) - 1e-9) * large


def similar_pairs(pairs: DataFrame, shingle_sets: DataFrame, threshold: float = THRESHOLD,
                  id_col: str = "doc_id") -> DataFrame:
    """Candidate pairs whose exact Jaccard similarity is at least ``threshold``.

    Sizes are compared on narrow rows first; sets are fetched for the pairs
    that can still reach the threshold.
    """
    sizes = shingle_sets.select(id_col, F.size("shingles").alias("_n"))
    n = lambda c: sizes.select(F.col(id_col).alias(c), F.col("_n").alias(f"_n_{c}"))
    able = (pairs.join(n("first"), "first").join(n("second"), "second")
            .filter(size_test(threshold, F.col("_n_first"), F.col("_n_second"))).select(*pairs.columns))
    return (pair_similarity(able, shingle_sets, id_col)
            .filter(F.col("similarity") >= F.lit(float(threshold))))


def signature_similarity(pairs: DataFrame, signatures: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add ``matching_rows`` (equal signature positions) and ``estimate`` = matching / length."""
    s1 = signatures.select(F.col(id_col).alias("first"), F.col("signature").alias("_g1"))
    s2 = signatures.select(F.col(id_col).alias("second"), F.col("signature").alias("_g2"))
    joined = pairs.join(s1, "first").join(s2, "second")
    matching = matching_positions("_g1", "_g2").cast("long")
    return joined.select(*pairs.columns, matching.alias("matching_rows"),
                         (matching.cast("double") / F.size("_g1").cast("double")).alias("estimate"))


def similar_to(pairs: DataFrame, query_ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, similar_id)``: every partner of each queried id, on either side of a pair.

    ``query_ids`` holds one id column named ``id_col``; a single lookup is a
    one-row frame. The pairs are unioned in both orientations and semi-joined
    with the queries, so the lookup is one distributed join.
    """
    both = (pairs.select(F.col("first").alias(id_col), F.col("second").alias("similar_id"))
            .unionByName(pairs.select(F.col("second").alias(id_col), F.col("first").alias("similar_id"))))
    return both.join(query_ids.select(id_col).distinct(), id_col, "left_semi")


def similar_to_id(pairs: DataFrame, doc_id, id_col: str = "doc_id") -> DataFrame:
    """``(similar_id)``: the partners of one document (a filter on either side of the pairs)."""
    first = pairs.filter(F.col("first") == F.lit(doc_id)).select(F.col("second").alias("similar_id"))
    second = pairs.filter(F.col("second") == F.lit(doc_id)).select(F.col("first").alias("similar_id"))
    return first.unionByName(second)
