"""The near-duplicate job with exact copies collapsed before any pair work.

Documents with identical shingle sets ("copies") have identical signatures,
share every bucket and have Jaccard 1.0 with each other and the same
similarity to everybody else. The job therefore keys all pair work by a *copy
key* of the shingle set (its size and 96 hash bits: ``xxhash64``, ``hash``)
instead of by document; sets with equal keys are taken for equal.

1. copy key and signature per document (one pass over the texts, no shuffle);
   only those are stored, not the shingle sets, which are larger than the texts;
2. band rows deduplicated to ``(copy_key, band, bucket)`` (narrow rows; copies
   collapse map-side);
3. key pairs from the bucket self-join; the sizes in the keys rule out most of
   the false ones before anything is fetched; the others are verified by exact
   Jaccard on one text of each key, fetched past a Bloom filter, so that no
   other text and no shingle set crosses an exchange;
4. document pairs only at the end: key pairs joined with the key members on
   both sides, plus the pairs inside each copy group (similarity 1.0).

A copy group holding a third of the corpus thus costs one row per band in
steps 2-3, not a quadratic number of bucket pairs. Step 4 is the size of the
answer itself and runs as distributed joins (AQE splits hot keys).

Rows that repeat a document id are one document: the text with the smallest
copy key stands for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_family, shingle_hashes, shingles_with_signature
from tessera.operators import quality as q
from tessera.operators import similarity as sim
from tessera.operators.exact import exact_similar_texts
from tessera.operators.joins import PAIR_CELL, ensure_parallelism, pairs_across_groups, pairs_within_groups
from tessera.sources.storage import materialize, release, row_count


@dataclass(frozen=True)
class LshParams:
    shingle_size: int = sim.SHINGLE_SIZE
    bands: int = sim.BANDS
    rows: int = sim.ROWS
    seed: int = sim.SEED
    threshold: float = sim.THRESHOLD

    @property
    def n_functions(self) -> int:
        return self.bands * self.rows

    def hash_params(self) -> list[tuple[int, int]]:
        return hash_family(self.n_functions, self.seed)


def copy_key(shingles_col: str = "shingles"):
    """Key of a sorted distinct shingle array: its size and 96 hash bits (xxhash64, murmur3)."""
    return F.struct(F.size(shingles_col).alias("n"), F.xxhash64(shingles_col).alias("h1"),
                    F.hash(shingles_col).alias("h2"))


def key_representatives(members: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``(copy_key, rep_id)``: the smallest document of each copy key (of those in ``keys``, if given).

    Computed on narrow ``(doc_id, copy_key)`` rows only.
    """
    if keys is not None:
        members = members.join(keys.select("copy_key").distinct(), "copy_key", "left_semi")
    return members.groupBy("copy_key").agg(F.min("doc_id").alias("rep_id"))


def can_reach(threshold: float):
    """The size test on a pair of copy keys, which carry the sizes of their sets."""
    return sim.size_test(threshold, F.col("first.n"), F.col("second.n"))


def key_pair_similarity(pairs: DataFrame, members: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``(first, second, similarity)`` of pairs of copy keys, from one text of each key; stored."""
    pairs = materialize(pairs.select("first", "second"), "key_pairs")
    keys = (pairs.select(F.col("first").alias("copy_key")).unionByName(pairs.select(F.col("second").alias("copy_key"))))
    reps = materialize(key_representatives(members, keys), "key_reps")
    rep = lambda c: reps.select(F.col("copy_key").alias(c), F.col("rep_id").alias(f"_{c}"))
    by_rep = materialize(pairs.join(rep("first"), "first").join(rep("second"), "second").select(
        F.col("_first").alias("first"), F.col("_second").alias("second"), F.col("first").alias("_k1"), F.col("second").alias("_k2")),
        "rep_pairs")
    behind: list[DataFrame] = []
    out = materialize(sim.text_pair_similarity(by_rep, docs, k, behind=behind).select(
        F.col("_k1").alias("first"), F.col("_k2").alias("second"), "similarity"), "key_similarity")
    release(pairs, reps, by_rep, *behind)
    return out


def copy_group_pairs(members: DataFrame, split: int = PAIR_CELL, max_group: int | None = None) -> DataFrame:
    """``(copy_key, first, second)``: all id pairs inside each copy group, first < second.

    A group of m copies yields m (m - 1) / 2 pairs from m narrow rows; the
    grid-salted self-join of :func:`pairs_within_groups` spreads a hot group
    over many tasks.
    """
    return pairs_within_groups(members.select("copy_key", "doc_id"), ["copy_key"], "doc_id", cell=split,
                               max_group=max_group)


@dataclass
class SignedDocuments:
    params: LshParams
    docs: DataFrame                # (doc_id, text)                 documents with a shingle at least, an id once
    signatures: DataFrame          # (doc_id, copy_key, signature)  one row per document
    stored: list[DataFrame] = field(default_factory=list)   # materialised tables behind the above

    def members(self) -> DataFrame:
        """``(doc_id, copy_key)`` of every document."""
        return self.signatures.select("doc_id", "copy_key")

    def release(self) -> None:
        """Delete the intermediate tables; nothing derived from them may run afterwards."""
        release(*self.stored)


@dataclass
class NearDuplicates(SignedDocuments):
    key_candidates: DataFrame | None = None   # (first, second) copy keys, first < second
    verified: DataFrame | None = None         # (first, second, similarity) for the candidates that pass the size test

    # ------------------------------------------------------------- key level
    def largest_copy_group(self) -> int:
        """Members of the largest copy group (one narrow aggregation, computed once)."""
        if getattr(self, "_largest", None) is None:
            self._largest = (self.members().groupBy("copy_key").agg(F.count(F.lit(1)).alias("_m"))
                             .agg(F.max("_m").alias("_mx")).first()["_mx"]) or 0
        return self._largest

    def shingles(self) -> DataFrame:
        """``(doc_id, shingles)`` of every document, computed from the texts."""
        return ensure_parallelism(self.docs, "doc_id").select(
            "doc_id", shingle_hashes(F.col("text"), self.params.shingle_size).alias("shingles"))

    def key_similarity(self) -> DataFrame:
        """``(first, second, similarity)`` of all key candidates; those that the size test left out are verified now, once."""
        if getattr(self, "_others", None) is None:
            others = self.key_candidates.filter(~can_reach(self.params.threshold))
            self._others = key_pair_similarity(others, self.members(), self.docs, self.params.shingle_size)
            self.stored.append(self._others)
        return self.verified.unionByName(self._others)

    def key_similar(self) -> DataFrame:
        return self.verified.filter(F.col("similarity") >= F.lit(float(self.params.threshold)))

    # ------------------------------------------------------------- doc level
    def expand(self, key_pairs: DataFrame, intra_value_cols: dict | None = None,
               include_copies: bool = True) -> DataFrame:
        """Document pairs ``(first, second, ...)`` for key pairs, plus pairs inside copy groups.

        ``intra_value_cols`` gives the value columns of pairs of copies (e.g.
        ``{"similarity": 1.0}``); the key pairs must carry the same columns.
        With ``include_copies=False`` only the pairs of the given key pairs are
        returned (e.g. for false negatives, which never lie inside a copy group).
        """
        values = [c for c in key_pairs.columns if c not in ("first", "second")]
        largest = self.largest_copy_group()
        across = (pairs_across_groups(key_pairs, self.members(), "copy_key", "doc_id", max_group=largest)
                  .select(F.least("_x1", "_x2").alias("first"), F.greatest("_x1", "_x2").alias("second"),
                          *values))
        if not include_copies:
            return across
        intra_value_cols = intra_value_cols or {}
        within = (copy_group_pairs(self.members(), max_group=largest)
                  .select("first", "second", *[F.lit(intra_value_cols[v]).alias(v) for v in values]))
        return across.unionByName(within)

    def candidate_pairs(self) -> DataFrame:
        return self.expand(self.key_candidates)

    def pair_similarity(self) -> DataFrame:
        return self.expand(self.key_similarity(), {"similarity": 1.0})

    def similar_pairs(self) -> DataFrame:
        return self.expand(self.key_similar(), {"similarity": 1.0})


def sign_documents(docs: DataFrame, params: LshParams = LshParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> SignedDocuments:
    """Copy key and signature per document: one pass over the texts."""
    kept = (sim.doc_length_filter(docs, params.shingle_size, id_col, text_col)
            .select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    both = ensure_parallelism(kept, "doc_id").select("doc_id", shingles_with_signature(
        F.col("text"), params.shingle_size, params.hash_params()).alias("_r"))
    signatures = materialize(both.select("doc_id", copy_key("_r.shingles").alias("copy_key"), "_r.signature"), "signatures")
    stored = [signatures]
    repeated = materialize(signatures.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("copy_key").alias("copy_key"))
                           .filter("n > 1").select("doc_id", "copy_key"), "repeated_ids")
    stored.append(repeated)
    if row_count(repeated) > 0:
        chosen = signatures.join(repeated, ["doc_id", "copy_key"], "left_semi").dropDuplicates(["doc_id"])
        signatures = materialize(signatures.join(repeated, "doc_id", "left_anti").unionByName(chosen), "signatures")
        # the text that a repeated id goes by
        keyed = kept.join(repeated, "doc_id").withColumn("_k", copy_key(shingle_hashes(F.col("text"), params.shingle_size)))
        one = keyed.filter("_k = copy_key").dropDuplicates(["doc_id"]).select("doc_id", "text")
        kept = materialize(kept.join(repeated.select("doc_id"), "doc_id", "left_anti").unionByName(one), "unique_docs")
        stored += [signatures, kept]
    return SignedDocuments(params, kept, signatures, stored)


def find_near_duplicates(docs: DataFrame, params: LshParams = LshParams(),
                         id_col: str = "doc_id", text_col: str = "text") -> NearDuplicates:
    """Run shingling, MinHash, LSH and verification; see the module doc for the plan."""
    return pairs_of_signed(sign_documents(docs, params, id_col, text_col))


def pairs_of_signed(signed: SignedDocuments) -> NearDuplicates:
    """LSH and verification over documents that are signed already."""
    params = signed.params
    key_bands = (sim.lsh_bands(signed.signatures.select("copy_key", "signature"), params.bands, params.rows, "copy_key")
                 .distinct())
    key_candidates = materialize(sim.candidate_pairs(key_bands, "copy_key"), "key_candidates")
    verified = key_pair_similarity(key_candidates.filter(can_reach(params.threshold)), signed.members(), signed.docs,
                                   params.shingle_size)
    return NearDuplicates(params, signed.docs, signed.signatures, [*signed.stored, key_candidates, verified],
                          key_candidates, verified)


@dataclass
class QualityReport:
    sample: DataFrame              # (round, doc_id)
    fp: DataFrame                  # (round, candidates, verified, fp_rate)
    fn: DataFrame                  # (round, n_docs, candidates, false_negatives, fn_rate)
    fn_pairs: DataFrame            # (round, first, second, similarity)
    summary: DataFrame             # (rounds, fraction, avg_fp_rate, avg_fn_rate)


def exact_key_pairs(nd: NearDuplicates, keys: DataFrame | None = None) -> DataFrame:
    """Exact key pairs ``(first, second, similarity)`` with Jaccard >= threshold, stored.

    The join runs on the representatives' ids; only the resulting pairs are
    mapped back to copy keys, oriented so that ``first < second``. Without
    ``keys`` the whole corpus is compared.
    """
    k = nd.params.shingle_size
    reps = materialize(key_representatives(nd.members(), keys), "exact_reps", {"tokens": F.sum(F.col("copy_key.n").cast("long"))})
    ids = reps.select(F.col("rep_id").alias("doc_id"))
    pairs = exact_similar_texts(nd.docs, nd.params.threshold, k, ids, reps._tessera_metrics["tokens"])
    r1 = reps.select(F.col("rep_id").alias("first"), F.col("copy_key").alias("_k1"))
    r2 = reps.select(F.col("rep_id").alias("second"), F.col("copy_key").alias("_k2"))
    keyed = pairs.join(r1, "first").join(r2, "second")
    out = materialize(keyed.select(F.least("_k1", "_k2").alias("first"), F.greatest("_k1", "_k2").alias("second"),
                                   "similarity"), "key_exact")
    out._tessera_metrics["candidates"] = pairs._tessera_metrics["candidates"]
    release(reps, pairs)
    nd.stored.append(out)
    return out


def analyze_quality(nd: NearDuplicates, fraction: float = 0.1, rounds: int = 1,
                    seed: int | None = None) -> QualityReport:
    """False-positive / false-negative analysis over ``rounds`` seeded samples."""
    seed = nd.params.seed if seed is None else seed
    sample = materialize(q.doc_sample(nd.members().select("doc_id"), fraction, seed, rounds), "sample")
    keys = materialize(q.sampled_keys(sample, nd.members()), "sampled_keys")
    nd.stored += [sample, keys]
    exact = exact_key_pairs(nd, keys)
    fn_keys = q.false_negative_key_pairs(exact, nd.key_candidates)
    round_ids = sample.sparkSession.range(rounds).select(F.col("id").cast("int").alias("round"))
    fp = q.false_positive_rate(round_ids, keys, nd.key_candidates, nd.key_similar())
    fn = q.false_negative_rate(round_ids, keys, nd.key_candidates, fn_keys)
    return QualityReport(sample, fp, fn, q.false_negatives(sample, nd.members(), fn_keys),
                         q.fpfn_summary(fp, fn, fraction))
