"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the words in proportion to its weight, but at
most ``max_epochs`` times what it has; what a clamped source cannot take is
shared out again among the others by weight until nobody is above its clamp.
The fixed point of that redistribution is a level: a source takes
``min(max_epochs * size, weight * level)``. Sources ordered by
``max_epochs * size / weight`` are clamped in that order, so one running sum
over the sources finds the level.

A target of 2.3 times a source's size means two whole repetitions of every
document and a third one of a seeded sample that makes up 0.3 of the words:
the documents of a source in the order of a seeded hash, up to the place
where their running size meets the rest. The place is found on the sums of
65,536 hash buckets; only the one bucket that holds it is looked at document
by document, so a source with a third of all rows is never gathered in a
task. The outcome per source is one row, and whether a document is taken is
an expression over its own hash and that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.storage import materialize

from .common import hidden, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)`` rows, one per source (null is a source)."""
    n = len(weights)
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(n))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    ranked = (sizes.withColumn("weight", weight)
              .withColumn("cap", F.col("source_size") * max_epochs)
              .withColumn("full_at", F.col("cap") / F.col("weight")))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    ranked = ranked.withColumn("level", level).withColumn("nth", F.row_number().over(order))
    # sources below the level are full; the first that isn't fixes the level for all
    ranked = ranked.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"),
                                                     F.struct("nth", "level"))).over(all_rows)["level"])
    return ranked.select("source", "source_size",
                         F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def seeded_hash(key: Column, seed: int) -> Column:
    """The place of a document in its source's order (hex digits)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def hash_bucket(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 4), 16, 10).cast("int")


def plan_mix(narrow: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source: ``source, source_size, target, whole, cut, last, share``.

    ``narrow`` has ``source, size, h``. A document is taken ``whole`` times,
    and once more if its bucket is below ``cut``, or in ``cut`` and its hash
    below ``last``; rows with the hash ``last`` itself are taken to the
    ``share`` that fits (1 unless several rows have one key).
    """
    by_bucket = narrow.groupBy("source", hash_bucket(F.col("h")).alias("bucket")).agg(F.sum("size").alias("size"))
    by_bucket = materialize(by_bucket, "mix-buckets")
    targets = source_targets(by_bucket.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = (targets.withColumn("whole", whole.cast("int"))
               .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    targets = materialize(targets, "mix-targets")
    t = targets.select(F.col("source").alias("t_source"), "rest")

    # the first bucket that doesn't fit as a whole; the words that lie before it
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (by_bucket.withColumn("end", F.sum("size").over(upto))
            .join(t, F.col("source").eqNullSafe(F.col("t_source")))
            .filter(F.col("end") > F.col("rest"))
            .groupBy("source").agg(F.min("bucket").alias("cut"),
                                   F.min(F.struct("bucket", (F.col("end") - F.col("size")).alias("v")))["v"].alias("start")))
    cuts = materialize(targets.select(F.col("source").alias("t_source"), "rest")
                       .join(cuts, F.col("t_source").eqNullSafe(F.col("source")))
                       .select("t_source", "rest", "cut", "start"), "mix-cuts")

    # inside that bucket, document by document (rows of one hash together)
    edge = (narrow.withColumn("bucket", hash_bucket(F.col("h")))
            .join(cuts, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("bucket") == F.col("cut")))
            .groupBy("source", "h", "rest", "start").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("m")))
    run = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.col("start") + F.sum("size").over(run) - F.col("size")
    fits = (2 * begin + F.col("size")) <= 2 * F.col("rest")
    share = (F.when((F.col("m") == 1) | (F.col("size") == 0), F.when(fits, F.lit(1.0)).otherwise(F.lit(0.0)))
             .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("rest") - begin) / F.col("size")))))
    last = (edge.withColumn("share", share).filter(F.col("share") > 0)
            .groupBy("source").agg(F.max("h").alias("last"), F.max(F.struct("h", "share"))["share"].alias("share"))
            .withColumnRenamed("source", "l_source"))
    cuts = cuts.withColumnRenamed("t_source", "c_source").drop("rest", "start")
    return materialize(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("l_source")), "left")
        .select("source", "source_size", "target", "whole", "cut", "last", "share"), "mix-plan")


def repetitions(h: Column, row: Column, plan: str = "p.") -> Column:
    """How often the mix takes a document, from its hash, a number of its row, and its source's row of the plan."""
    p = lambda name: F.col(f"{plan}{name}")
    bucket = hash_bucket(h)
    tie = (h == p("last")) & (F.pmod(F.xxhash64(row), F.lit(1 << 20)) < p("share") * (1 << 20))
    extra = p("cut").isNull() | (bucket < p("cut")) | ((bucket == p("cut")) & F.coalesce((h < p("last")) | tie, F.lit(False)))
    return p("whole") + F.when((p("target") > p("whole") * p("source_size")) & extra, F.lit(1)).otherwise(F.lit(0))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``(key, size, source_size, target, times)``: a row per document, ``times`` from 0 to ``max_epochs``.

    ``size`` counts the words (null text: 0). Sources in code point order,
    null last, have the weights in turn; the targets share the words of all.
    Documents without words take part with size 0. Rows that repeat a key
    are drawn one by one. An empty table gives no rows; only the three named
    columns are read.
    """
    narrow = materialize(
        docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
                    F.size(words(F.col(text))).cast("long").alias("size"), seeded_hash(F.col(key), seed).alias("h"))
        .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    plan = plan_mix(narrow, weights, max_epochs)
    return (narrow.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
            .select(F.col("d.key").alias(key), F.col("d.size").alias("size"), F.col("p.source_size").alias("source_size"),
                    F.col("p.target").alias("target"), repetitions(F.col("d.h"), F.col("d.row")).alias("times")))


def repeat_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                     weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs`` only.

    The plan is made on narrow rows; the texts are then read once more and
    meet one row per source, so they are never shuffled on the source.
    """
    narrow = materialize(
        docs.select(F.col(source).cast("string").alias("source"),
                    F.size(words(F.col(text))).cast("long").alias("size"), seeded_hash(F.col(key), seed).alias("h")),
        "mix-sizes")
    plan = plan_mix(narrow, weights, max_epochs)
    own, times = hidden(docs, stem="row"), hidden(docs, stem="times")
    plan = plan.select(F.struct("*").alias(hidden(docs, stem="plan")))
    p = plan.columns[0]
    return (docs.withColumn(own, F.monotonically_increasing_id())
            .join(plan, docs[source].cast("string").eqNullSafe(F.col(f"{p}.source")))
            .withColumn(times, repetitions(seeded_hash(docs[key], seed), F.col(own), f"{p}."))
            .filter(F.col(times) > 0)
            .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op10(docs: DataFrame) -> DataFrame:
    """The digest of the registered query: words taken per document."""
    return mix_documents(docs).select("doc_id", "size", "source_size", "target",
                                      (F.col("size") * F.col("times")).cast("long").alias("taken"))
