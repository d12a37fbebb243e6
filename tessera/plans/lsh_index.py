"""A stored LSH index: near duplicates of some documents without mining the corpus again.

``build_index`` makes one pass over the corpus and one shuffle of narrow rows:

* ``buckets``  ``(band, part, bucket, copy_key, rep_id)`` one row per distinct
  shingle set and band, in folders by band and by part (the bucket's leading
  bits), ordered by bucket inside;
* ``members``  ``(part, copy_key, doc_id)`` the documents of each set, by the
  key's part;
* ``texts``    ``(part, rep_id, text)`` one text of each set, by the id's part,
  ordered by id inside.

``lookup`` shingles the queried documents only, reads the folders that their
buckets name, tests sizes on the keys, fetches the texts of the sets that are
left from their folders, and verifies those. Nothing is read but the folders
that are probed, and no document but the probed ones is compared; work grows
with the queries and their neighbours.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import shingles_with_signature, text_similarity
from tessera.operators import similarity as sim
from tessera.operators.joins import ensure_parallelism
from tessera.plans.near_duplicates import LshParams, SignedDocuments, can_reach, copy_key, key_representatives
from tessera.sources.storage import materialize, release

PARTS = 16  # folders a band; more for larger corpora


def _part(value: Column, parts: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(value), 32), F.lit(parts)).cast("int")


def _write(df: DataFrame, path: str, by: list[str], order: list[str]) -> str:
    """The schema of the table written, as JSON (an empty one has no file to take it from)."""
    # one hash partitioning by folder and a piece of the order keeps files few and lets hot folders have several
    (df.repartition(*by, F.pmod(F.xxhash64(order[0]), F.lit(8))).sortWithinPartitions(*by, *order)
     .write.mode("errorifexists").partitionBy(*by).parquet(path))
    return df.select(*[c for c in df.columns if c not in by], *by).schema.json()


class LshIndex:
    def __init__(self, spark: SparkSession, path: str):
        """An index written by :func:`build_index` at ``path``."""
        self.spark, self.path = spark, path.rstrip("/")
        given = json.loads(spark.read.parquet(f"{self.path}/params").first()["params"])
        self.parts = given.pop("parts")
        self.schemas = {name: T.StructType.fromJson(json.loads(kind)) for name, kind in given.pop("schemas").items()}
        self.params = LshParams(**given)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    def _in_parts(self, name: str, wanted: DataFrame, keys: list[str]) -> DataFrame:
        """Rows of a table in the folders that ``wanted`` names: at most bands x parts values, so they are listed."""
        folders = [tuple(r) for r in wanted.select(*keys).distinct().collect()]
        if not folders:
            return self._table(name).filter(F.lit(False))
        if len(keys) == 1:
            return self._table(name).filter(F.col(keys[0]).isin([f[0] for f in folders]))
        named = None
        for first in sorted({f[0] for f in folders}):
            one = (F.col(keys[0]) == first) & F.col(keys[1]).isin([f[1] for f in folders if f[0] == first])
            named = one if named is None else named | one
        return self._table(name).filter(named)

    def lookup(self, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(id, similar_id, similarity)``: the indexed documents that LSH proposes and the threshold confirms.

        ``queries`` are rows of id and text, indexed or not; texts without a
        shingle find nothing. A document is never its own neighbour: a row of
        the index with the query's id is left out.
        """
        p, parts = self.params, self.parts
        kept = (sim.doc_length_filter(queries, p.shingle_size, id_col, text_col)
                .select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
        signed = materialize(ensure_parallelism(kept, "doc_id").select("doc_id", "text", shingles_with_signature(
            F.col("text"), p.shingle_size, p.hash_params()).alias("_r")).select(
                "doc_id", "text", copy_key("_r.shingles").alias("first"), "_r.signature"), "lookup_queries")
        # equal sets are looked up once
        probes = materialize(sim.lsh_bands(signed.select("first", "signature"), p.bands, p.rows, "first").distinct()
                             .withColumn("part", _part(F.col("bucket"), parts)), "lookup_probes")
        buckets = self._in_parts("buckets", probes, ["band", "part"])
        found = materialize(
            probes.join(buckets, ["band", "part", "bucket"])
            .select("first", F.col("copy_key").alias("second"), "rep_id").distinct().filter(can_reach(p.threshold))
            .withColumn("part", _part(F.col("rep_id"), parts)), "lookup_found")
        texts = self._in_parts("texts", found, ["part"])
        other = found.filter("first <> second").join(texts, ["part", "rep_id"]).select(
            "first", "second", F.col("text").alias("_other"))
        one = signed.groupBy("first").agg(F.min("text").alias("_text"))
        close = other.join(one, "first").select(
            "first", "second", text_similarity(F.col("_text"), F.col("_other"), p.shingle_size).alias("similarity"))
        close = close.filter(F.col("similarity") >= F.lit(float(p.threshold))).unionByName(
            found.filter("first = second").select("first", "second", F.lit(1.0).alias("similarity")))
        close = materialize(close.withColumn("part", _part(F.col("second"), parts)), "lookup_close")
        members = self._in_parts("members", close, ["part"]).select("part", F.col("copy_key").alias("second"), F.col("doc_id").alias("similar_id"))
        out = (close.join(members, ["part", "second"]).join(signed.select("first", "doc_id"), "first")
               .filter(F.col("similar_id") != F.col("doc_id")).select(F.col("doc_id").alias(id_col), "similar_id", "similarity"))
        out = materialize(out, "lookup")
        release(signed, probes, found, close)
        return out


def build_index(signed: SignedDocuments, path: str, parts: int = PARTS) -> LshIndex:
    """Write the index of signed documents."""
    spark, path, p = signed.signatures.sparkSession, path.rstrip("/"), signed.params
    members = signed.members()
    reps = materialize(key_representatives(members), "index_reps")
    bands = sim.lsh_bands(signed.signatures.select("copy_key", "signature"), p.bands, p.rows, "copy_key").distinct()
    schemas = {"buckets": _write(bands.join(reps, "copy_key").withColumn("part", _part(F.col("bucket"), parts)),
                                 f"{path}/buckets", ["band", "part"], ["bucket"]),
               "members": _write(members.withColumn("part", _part(F.col("copy_key"), parts)), f"{path}/members",
                                 ["part"], ["copy_key", "doc_id"])}
    ids = reps.select(F.col("rep_id").alias("doc_id"))
    texts = sim.texts_of(signed.docs, ids).join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("rep_id"), "text")
    schemas["texts"] = _write(texts.withColumn("part", _part(F.col("rep_id"), parts)), f"{path}/texts", ["part"], ["rep_id"])
    spark.createDataFrame([(json.dumps(asdict(p) | {"parts": parts, "schemas": schemas}),)], "params string").coalesce(1).write.parquet(f"{path}/params")
    release(reps)
    return LshIndex(spark, path)
