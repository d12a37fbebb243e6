"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.storage import materialize, release


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` from ``(a, b)`` rows of integers: ``comp`` is the smallest node reachable.

    Alternates two steps on the stored edge table until it stays the same:
    every node hands its smallest neighbour to its larger neighbours, then to
    its smaller ones. The number of rounds grows with the logarithm of the
    longest chain. Both steps are a partial aggregation and an equi-join, so
    a node with very many links is split by adaptive execution. Nodes without
    links don't appear; no links give an empty table.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), "edges", {"h": F.bit_xor(F.xxhash64("u", "v"))})
    while edges._tessera_rows:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .filter("u <> v").distinct())
        larger = materialize(larger, "edges-large")
        low = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = (larger.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct())
        after = materialize(smaller, "edges", {"h": F.bit_xor(F.xxhash64("u", "v"))})
        same = (after._tessera_rows, after._tessera_metrics) == (edges._tessera_rows, edges._tessera_metrics)
        release(edges, larger)
        edges = after
        if same:
            break
    # a star now: every node points at the smallest of its component
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()))
