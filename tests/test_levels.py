"""Levels counted over pair cells and over bitmaps equal those counted by joins."""

import random
from collections import Counter
from itertools import combinations

import pytest

from tessera.operators import itemsets as its
from tessera.operators import levels as lv
from tessera.plans.market_basket import mine_itemsets


def random_baskets(spark, n_baskets, n_items, size, seed=1, hot=0.0):
    rng = random.Random(seed)
    rows = {b: {f"i{rng.randrange(n_items):05d}" for _ in range(rng.randint(1, size))} for b in range(n_baskets)}
    for b in range(n_baskets):
        if rng.random() < hot:
            rows[b] |= {"i00000", "i00001"}
    return rows, spark.createDataFrame([(b, i) for b, items in rows.items() for i in items], "basket long, item string").repartition(4)


def plain(rows, k, threshold):
    counts = Counter(c for items in rows.values() for c in combinations(sorted(items), k))
    return {c: n for c, n in counts.items() if n >= threshold}


def found(df, k):
    return {tuple(r[f"item_{j}"] for j in range(1, k + 1)): r.support for r in df.collect()}


@pytest.mark.parametrize("cells", [4, 64, 1 << 12])
def test_cells_change_no_pair(spark, cells):
    rows, df = random_baskets(spark, 300, 120, 8, hot=0.3)
    mined = mine_itemsets(df, 3, max_k=3, pair_cells=cells)
    assert lv.is_wide(mined.items.count(), 64)
    assert found(mined.pairs, 2) == plain(rows, 2, 3) and found(mined.triples, 3) == plain(rows, 3, 3)


def test_poor_cells_halve_the_pair_shuffle(spark):
    """50,000 items of small support: at most half of the pairs are left to be shuffled."""
    rng = random.Random(2)
    rows = [(b, rng.randrange(50_000)) for b in range(12_000) for _ in range(10)]
    rows += [(b, x) for b in range(0, 12_000, 400) for x in (60_000, 60_001)]
    df = spark.createDataFrame(sorted(set(rows)), "basket long, item long")
    whole = its.basket_pairs(df).count()
    left = lv.pruned_pairs(df, 4)
    assert left.count() <= whole / 2
    assert found(lv.frequent_pairs_by_cells(df, 4), 2) == found(its.count_itemsets(its.basket_pairs(df), ["item_1", "item_2"], df, 4), 2)
    # the cells are what pass 1 shuffles: never more than the table has
    assert lv.rich_cells(its.basket_pairs(df), 1, 256).count() == 256


@pytest.mark.parametrize("block_rows", [50, 10_000])
def test_bitmaps_equal_joins(spark, monkeypatch, block_rows):
    monkeypatch.setattr(lv.count_by_bitmaps, "__defaults__", (block_rows,))
    rows, df = random_baskets(spark, 400, 14, 12, seed=3)
    by_bits, by_joins = (mine_itemsets(df, 20, bitmaps=b) for b in (True, False))
    assert found(by_bits.triples, 3) == found(by_joins.triples, 3) == plain(rows, 3, 20)


def test_measure_takes_either_way(spark, monkeypatch):
    used = []
    plan = lv.count_by_bitmaps
    monkeypatch.setattr(lv, "count_by_bitmaps", lambda *a: used.append(1) or plan(*a))
    rows, dense = random_baskets(spark, 200, 10, 9, seed=4)
    assert found(mine_itemsets(dense, 0.1).triples, 3) == plain(rows, 3, 20) and used
    used.clear()
    rows, sparse = random_baskets(spark, 300, 90, 4, seed=5)
    assert found(mine_itemsets(sparse, 2).triples, 3) == plain(rows, 3, 2) and not used


def test_nothing_to_count(spark):
    none = spark.createDataFrame([], "basket long, item string")
    for bitmaps in (True, False):
        mined = mine_itemsets(none, 2, bitmaps=bitmaps)
        assert mined.pairs.count() == 0 and mined.triples.count() == 0
    rows, df = random_baskets(spark, 30, 50, 3, seed=6)
    assert mine_itemsets(df, 25, bitmaps=True).triples.count() == 0


def test_absolute_support():
    assert its.absolute_support(5, 100) == 5 and its.absolute_support(0.051, 100) == 6
    for wrong in (0, -1, 0.0, 1.0, 1.5):
        with pytest.raises(ValueError):
            its.absolute_support(wrong, 100)
    with pytest.raises(TypeError):
        its.absolute_support(True, 100)
