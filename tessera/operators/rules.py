"""Association rules ``X => {y}`` from frequent itemsets, scored four ways.

For every frequent itemset S (|S| >= 2) and every item y in S, the rule
``S \\ {y} => {y}`` is generated (single-item right-hand side). With n the
number of baskets, c the support of S, l the support of the left side and h
the support of y:

    confidence = c / l
    interest   = confidence - h / n
    lift       = n * confidence / h
    std_lift   = (c - m) / (min(l, h) - m),  m = max(l + h - n, 1)

The last is the standardised lift ``(lift - lower) / (upper - lower)`` with
``lower = max((l + h) / n - 1, 1 / n) / (l h / n^2)`` and ``upper = n / max(l,
h)``, multiplied out by ``l h / n``: its numerator and denominator are whole
numbers, so it is NULL exactly when the bounds coincide (e.g. an item that is
in every basket). The other metrics are in doubles (``l * h`` would overflow
bigint at cluster scale). Left-side supports come from one support table keyed by the sorted
item array, so 1- and 2-item left sides share a single join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.itemsets import itemset_array

RULE_COLUMNS = ["lhs", "rhs", "rule_count", "lhs_count", "rhs_count",
                "confidence", "interest", "lift", "std_lift"]


def _as_number(n) -> Column:
    return n if isinstance(n, Column) else F.lit(n)


def itemset_supports(levels: list[DataFrame]) -> DataFrame:
    """``(itemset array<item>, support)`` over the given levels (union by name)."""
    frames = [df.select(itemset_array(df).alias("itemset"), "support") for df in levels]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rule_generation(itemsets: DataFrame) -> DataFrame:
    """``(lhs array, rhs, rule_count)``: one rule per item of every itemset.

    The rule array is built from explicit column expressions (the itemset
    size is known from the schema), so it stays inside whole-stage codegen.
    """
    cols = [c for c in ("item_1", "item_2", "item_3") if c in itemsets.columns]
    if len(cols) < 2:
        raise ValueError("rules need itemsets of size >= 2")
    rules = F.array(*[
        F.struct(F.array(*[F.col(o) for o in cols if o != c]).alias("lhs"), F.col(c).alias("rhs"))
        for c in cols])
    return (itemsets.select(F.explode(rules).alias("r"), F.col("support").alias("rule_count"))
            .select("r.lhs", "r.rhs", "rule_count"))


def rule_counts(rules: DataFrame, items: DataFrame, lhs_levels: list[DataFrame]) -> DataFrame:
    """Attach ``lhs_count`` (support of the left side) and ``rhs_count``.

    Every subset of a frequent itemset is frequent, so both inner joins keep
    every rule.
    """
    supports = itemset_supports(lhs_levels).select(F.col("itemset").alias("lhs"), F.col("support").alias("lhs_count"))
    rhs = items.select(F.col("item").alias("rhs"), F.col("support").alias("rhs_count"))
    return rules.join(supports, "lhs").join(rhs, "rhs").select(
        "lhs", "rhs", "rule_count", "lhs_count", "rhs_count")


def rule_metrics(counts: DataFrame, n_baskets) -> DataFrame:
    """Add confidence, interest, lift and standardised lift (see module doc)."""
    n = _as_number(n_baskets).cast("double")
    c, l, h = (F.col(x).cast("double") for x in ("rule_count", "lhs_count", "rhs_count"))
    confidence = c / l
    least = F.greatest(F.col("lhs_count") + F.col("rhs_count") - _as_number(n_baskets).cast("long"), F.lit(1).cast("long"))
    range_ = F.least("lhs_count", "rhs_count") - least
    return (counts
            .withColumn("confidence", confidence)
            .withColumn("interest", F.col("confidence") - h / n)
            .withColumn("lift", n * F.col("confidence") / h)
            .withColumn("std_lift", F.try_divide((F.col("rule_count") - least).cast("double"), range_.cast("double"))))


def scored_rules(itemsets: DataFrame, items: DataFrame, lhs_levels: list[DataFrame],
                 n_baskets) -> DataFrame:
    """Rules of one itemset level with counts and all four metrics."""
    return rule_metrics(rule_counts(rule_generation(itemsets), items, lhs_levels), n_baskets)


def association_rules(items: DataFrame, pairs: DataFrame, triples: DataFrame | None,
                      n_baskets, min_std_lift: float = 0.2) -> DataFrame:
    """Rules from pairs and triples with ``std_lift >= min_std_lift``, best first."""
    parts = [scored_rules(pairs, items, [items], n_baskets)]
    if triples is not None:
        parts.append(scored_rules(triples, items, [items, pairs], n_baskets))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.filter(F.col("std_lift") >= F.lit(float(min_std_lift)))
            .select(*RULE_COLUMNS)
            .orderBy(F.col("std_lift").desc(), F.col("lhs"), F.col("rhs")))


def rule_lines(rules: DataFrame, dictionary: DataFrame, decimals: int = 6) -> DataFrame:
    """``line`` = ``{a, b} -> {c}: std_lift, lift, confidence, interest``, best rule first.

    An item without a description stands for itself. The order is made after
    the lookups, which don't keep that of their input. Left sides have at most two items here (rules come from k <= 3), so each
    position is looked up by its own left join against the dictionary.
    """
    d = dictionary.select("item", "description")
    out = rules.select("*", F.try_element_at("lhs", F.lit(1)).alias("_l1"),
                       F.try_element_at("lhs", F.lit(2)).alias("_l2"))
    for key, name in (("_l1", "_d1"), ("_l2", "_d2"), ("rhs", "_dr")):
        out = (out.join(d.select(F.col("item").alias(key), F.col("description").alias(name)), key, "left")
               .withColumn(name, F.coalesce(name, F.col(key).cast("string"))))
    fmt = f"%.{decimals}f"
    numbers = F.concat_ws(", ", *[F.format_string(fmt, F.col(m))
                                  for m in ("std_lift", "lift", "confidence", "interest")])
    line = F.concat(F.lit("{"), F.concat_ws(", ", "_d1", "_d2"), F.lit("} -> {"), F.col("_dr"),
                    F.lit("}: "), numbers)
    return (out.select(*RULE_COLUMNS, line.alias("line"))
            .orderBy(F.col("std_lift").desc(), F.col("lhs"), F.col("rhs")))
