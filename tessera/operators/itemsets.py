"""Frequent itemsets of size 1, 2 and 3 by level-wise (A-priori) counting.

Data model: a long *basket relation* ``(basket, item)``. Itemsets are scalar
columns ``item_1 < item_2 < item_3`` with their ``support`` (number of
baskets containing them); :func:`itemset_array` gives the sorted-array form.

Plan shape (no UDF, no driver collection):

* level 1 is a partial+final hash aggregation on ``item``;
* pruning by monotonicity is a ``left_semi`` join against the frequent level;
* level 2 is an equi self-join of the pruned relation on ``basket`` with
  ``l.item < r.item`` followed by a partial+final count per pair. Both join
  sides are one exchange (reused), and AQE's skew-join splits a hot basket;
* level 3 self-joins the per-basket *frequent* pairs on ``(basket, item_1)``,
  counts the triples, and keeps those whose third pair is frequent too (semi
  join of the counted rows, so no raw triple is shuffled for it).

Support thresholds are absolute counts (``int``) or a fraction of the number
of baskets (``float`` in (0, 1)); a fraction becomes a scalar subquery, so the
plan stays lazy.
"""

from __future__ import annotations

import math
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.joins import known_rows, pairs_within_groups

Support = Union[int, float]


# --------------------------------------------------------------------------- baskets

def basket_distinct(df: DataFrame, basket_col: str = "basket", item_col: str = "item") -> DataFrame:
    """Distinct ``(basket, item)`` rows; null baskets or items are dropped."""
    # explicit IsNotNull predicates (unlike na.drop) are pushed through joins to the scans
    return (df.filter(F.col(basket_col).isNotNull() & F.col(item_col).isNotNull())
            .select(F.col(basket_col).alias("basket"), F.col(item_col).alias("item")).distinct())


def basket_count(baskets: DataFrame) -> DataFrame:
    """One row, one column ``n_baskets``: the number of distinct baskets."""
    return baskets.agg(F.count_distinct("basket").alias("n_baskets"))


def absolute_support(min_support: Support, n_baskets: int) -> int:
    """The number of baskets that a support asks for: a count, or a fraction of ``n_baskets`` rounded up."""
    if isinstance(min_support, bool):
        raise TypeError("min_support must be a count or a fraction")
    if isinstance(min_support, int):
        if min_support < 1:
            raise ValueError("an absolute support must be >= 1")
        return min_support
    if not 0.0 < float(min_support) < 1.0:
        raise ValueError("a relative support must be in (0, 1)")
    return math.ceil(float(min_support) * n_baskets)


def support_threshold(baskets: DataFrame, min_support: Support, n_baskets: int | None = None) -> Column:
    """The absolute support threshold as a column (inclusive comparison).

    A fraction is multiplied by the number of baskets and rounded up: by the
    given ``n_baskets`` if known, else by a scalar subquery over ``baskets``.
    """
    if n_baskets is not None or isinstance(min_support, int):
        return F.lit(absolute_support(min_support, n_baskets or 0))
    absolute_support(min_support, 1)  # checks the range
    n = basket_count(baskets).scalar()
    return F.ceil(F.lit(float(min_support)) * n)


def item_dictionary(df: DataFrame, item_col: str, description_col: str) -> DataFrame:
    """``(item, description)``: one description per item, the smallest one on ties."""
    return (df.select(F.col(item_col).alias("item"), F.col(description_col).alias("description"))
            .filter(F.col("item").isNotNull())
            .groupBy("item").agg(F.min("description").alias("description")))


# --------------------------------------------------------------------------- level 1

def frequent_items(baskets: DataFrame, min_support: Support, n_baskets: int | None = None) -> DataFrame:
    """``(item, support)`` for items in at least ``min_support`` baskets."""
    counts = baskets.groupBy("item").agg(F.count(F.lit(1)).alias("support"))
    return counts.filter(F.col("support") >= support_threshold(baskets, min_support, n_baskets))


def prune_infrequent(baskets: DataFrame, items: DataFrame) -> DataFrame:
    """Keep the basket rows whose item is in ``items`` (A-priori monotonicity)."""
    return baskets.join(items.select("item"), "item", "left_semi").select("basket", "item")


def basket_itemlists(baskets: DataFrame, items: DataFrame) -> DataFrame:
    """``(basket, items)`` with the sorted array of the basket's frequent items.

    The lists are the result; each is as long as its own basket.
    """
    pruned = prune_infrequent(baskets, items)
    return pruned.groupBy("basket").agg(F.array_sort(F.collect_list("item")).alias("items"))


# --------------------------------------------------------------------------- level 2

def basket_pairs(pruned: DataFrame, max_items: int | None = None) -> DataFrame:
    """All ``(basket, item_1, item_2)`` with ``item_1 < item_2`` inside each basket.

    A self-join on ``basket``, salted on a grid for baskets with many items
    (see :func:`pairs_within_groups`). ``max_items`` bounds the items of one
    basket (the frequent-item vocabulary).
    """
    return (pairs_within_groups(pruned, ["basket"], "item", max_group=max_items)
            .select("basket", F.col("first").alias("item_1"), F.col("second").alias("item_2")))


def count_itemsets(rows: DataFrame, item_cols: list[str], baskets: DataFrame,
                   min_support: Support, n_baskets: int | None = None) -> DataFrame:
    counts = rows.groupBy(*item_cols).agg(F.count(F.lit(1)).alias("support"))
    return counts.filter(F.col("support") >= support_threshold(baskets, min_support, n_baskets))


def frequent_pairs(baskets: DataFrame, items: DataFrame, min_support: Support,
                   n_baskets: int | None = None) -> DataFrame:
    """``(item_1, item_2, support)`` for pairs of frequent items with enough support."""
    return pairs_of_pruned(prune_infrequent(baskets, items), baskets, min_support, n_baskets,
                           known_rows(items))


def pairs_of_pruned(pruned: DataFrame, baskets: DataFrame, min_support: Support,
                    n_baskets: int | None = None, max_items: int | None = None) -> DataFrame:
    """Level 2 over a basket relation that only holds frequent items."""
    return count_itemsets(basket_pairs(pruned, max_items), ["item_1", "item_2"], baskets, min_support, n_baskets)


# --------------------------------------------------------------------------- level 3

def _semi_on_pair(df: DataFrame, pairs: DataFrame, first: str, second: str) -> DataFrame:
    keep = pairs.select(F.col("item_1").alias(first), F.col("item_2").alias(second))
    return df.join(keep, [first, second], "left_semi")


def candidate_triples(pairs: DataFrame) -> DataFrame:
    """``(item_1, item_2, item_3)`` whose three 2-subsets are all frequent pairs.

    Prefix join of the frequent pairs with themselves on ``item_1`` (the
    classic A-priori candidate generation), then a semi join for the last pair.
    """
    joined = (pairs_within_groups(pairs.select("item_1", "item_2"), ["item_1"], "item_2",
                                  max_group=known_rows(pairs))
              .select("item_1", F.col("first").alias("item_2"), F.col("second").alias("item_3")))
    return _semi_on_pair(joined, pairs, "item_2", "item_3")


def frequent_triples(baskets: DataFrame, items: DataFrame, pairs: DataFrame,
                     min_support: Support, n_baskets: int | None = None) -> DataFrame:
    """``(item_1, item_2, item_3, support)`` counted only over candidate triples.

    Per basket, the frequent pairs present are joined with themselves on
    ``(basket, item_1)``; the resulting ``(a, b, c)`` have ``ab`` and ``ac``
    frequent. They are counted first (partial aggregation, one row per
    triple), and a semi join of the counted rows keeps those with ``bc``
    frequent as well.
    """
    return triples_of_pruned(prune_infrequent(baskets, items), pairs, baskets, min_support, n_baskets,
                             known_rows(items))


def triples_of_pruned(pruned: DataFrame, pairs: DataFrame, baskets: DataFrame, min_support: Support,
                      n_baskets: int | None = None, max_items: int | None = None) -> DataFrame:
    """Level 3 over a basket relation that only holds frequent items."""
    present = _semi_on_pair(basket_pairs(pruned, max_items), pairs, "item_1", "item_2")
    rows = (pairs_within_groups(present, ["basket", "item_1"], "item_2", max_group=max_items)
            .select("item_1", F.col("first").alias("item_2"), F.col("second").alias("item_3")))
    counted = count_itemsets(rows, ["item_1", "item_2", "item_3"], baskets, min_support, n_baskets)
    return (_semi_on_pair(counted, pairs, "item_2", "item_3")
            .select("item_1", "item_2", "item_3", "support"))


# --------------------------------------------------------------------------- encoding

def item_codes(items: DataFrame) -> DataFrame:
    """``(item, code)``: order-preserving long codes of the frequent items.

    A global sort (range partitioning) followed by ``monotonically_increasing_id``
    numbers the items in sort order, so ``code_a < code_b`` iff ``item_a < item_b``
    and level 2/3 enumeration can run on 8-byte keys instead of strings.
    """
    return items.select("item").orderBy("item").select("item", F.monotonically_increasing_id().alias("code"))


def encode_baskets(baskets: DataFrame, codes: DataFrame) -> DataFrame:
    """``(basket, item=code)`` for the rows whose item has a code (i.e. is frequent)."""
    return baskets.join(codes, "item").select("basket", F.col("code").alias("item"))


def decode_itemsets(encoded: DataFrame, codes: DataFrame) -> DataFrame:
    """Replace the codes in ``item_i`` columns by the items (one join per column)."""
    cols = [x for x in ("item_1", "item_2", "item_3") if x in encoded.columns]
    out = encoded
    for x in cols:
        out = (out.withColumnRenamed(x, f"_{x}")
               .join(codes.select(F.col("code").alias(f"_{x}"), F.col("item").alias(x)), f"_{x}").drop(f"_{x}"))
    return out.select(*cols, "support")


# --------------------------------------------------------------------------- reports

def itemset_array(df: DataFrame) -> Column:
    """The sorted ``array<item>`` of an itemset frame (items are stored ascending)."""
    cols = [c for c in ("item_1", "item_2", "item_3") if c in df.columns]
    if not cols:
        return F.array(F.col("item"))
    return F.array(*[F.col(c) for c in cols])


def itemset_counts(levels: dict[int, DataFrame]) -> DataFrame:
    """``(k, n_itemsets)``: how many frequent itemsets each level has."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_itemsets")).select(F.lit(k).alias("k"), "n_itemsets")
              for k, df in sorted(levels.items())]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _item_cols(df: DataFrame) -> list[str]:
    return [c for c in ("item", "item_1", "item_2", "item_3") if c in df.columns]


def _description_name(item_col: str) -> str:
    return "description" if item_col == "item" else "description_" + item_col.split("_")[-1]


def _attach_descriptions(frame: DataFrame, dictionary: DataFrame, bounded_rows: int | None) -> DataFrame:
    cols = _item_cols(frame)
    d = dictionary.select("item", "description")
    if bounded_rows is not None:
        # ``frame`` has at most ``bounded_rows`` rows: cut the dictionary down to
        # the items it mentions (<= 3 * bounded_rows rows) and broadcast that.
        wanted = F.broadcast(frame.select(F.explode(F.array(*cols)).alias("item")).distinct())
        d = F.broadcast(d.join(wanted, "item", "left_semi"))
    for c in cols:
        frame = frame.join(d.select(F.col("item").alias(c), F.col("description").alias(_description_name(c))),
                           c, "left")
    return frame


def label_itemsets(itemsets: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``description_i`` next to every ``item_i`` (left joins, item order kept)."""
    return _attach_descriptions(itemsets, dictionary, None)


def top_itemsets(itemsets: DataFrame, dictionary: DataFrame | None = None, n: int = 10) -> DataFrame:
    """The ``n`` best-supported itemsets with their ``rank`` (ties broken by items), labelled.

    ``orderBy(...).limit(n)`` plans as a distributed TakeOrdered: each task
    keeps its local top ``n`` and only those reach the final merge; the rank
    window then runs over at most ``n`` rows.
    """
    cols = _item_cols(itemsets)
    order = [F.col("support").desc(), *[F.col(c).asc() for c in cols]]
    top = itemsets.orderBy(*order).limit(n)
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    if dictionary is None:
        return top
    return _attach_descriptions(top, dictionary, n)
