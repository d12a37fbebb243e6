import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tessera.operators import itemsets as its
from tessera.plans import catalog
from tessera.plans.market_basket import mine_itemsets

from conftest import SF001


def _baskets(spark, rows):
    return its.basket_distinct(spark.createDataFrame(rows, "basket string, item string"))


def _brute(rows, support, k):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    counts = {}
    for items in baskets.values():
        for combo in combinations(sorted(items), k):
            counts[combo] = counts.get(combo, 0) + 1
    return {c: n for c, n in counts.items() if n >= support}


def _as_dict(df, k):
    cols = ["item"] if k == 1 else [f"item_{i}" for i in range(1, k + 1)]
    return {tuple(r[c] for c in cols): r["support"] for r in df.collect()}


def test_duplicates_and_nulls_are_dropped(spark):
    rows = [("b1", "x"), ("b1", "x"), ("b2", "x"), (None, "x"), ("b3", None)]
    b = _baskets(spark, rows)
    assert sorted(map(tuple, b.collect())) == [("b1", "x"), ("b2", "x")]
    assert its.basket_count(b).first()["n_baskets"] == 2
    assert _as_dict(its.frequent_items(b, 1), 1) == {("x",): 2}


def test_support_threshold_is_inclusive(spark):
    rows = [(f"b{i}", "a") for i in range(5)] + [(f"b{i}", "b") for i in range(4)]
    b = _baskets(spark, rows)
    assert _as_dict(its.frequent_items(b, 5), 1) == {("a",): 5}
    assert _as_dict(its.frequent_items(b, 4), 1) == {("a",): 5, ("b",): 4}


def test_relative_support_rounds_up(spark):
    rows = [(f"b{i}", "a") for i in range(10)] + [(f"b{i}", "b") for i in range(3)]
    b = _baskets(spark, rows)
    # 0.25 * 10 = 2.5 -> 3 baskets needed
    assert _as_dict(its.frequent_items(b, 0.25), 1) == {("a",): 10, ("b",): 3}
    assert _as_dict(its.frequent_items(b, 0.25, n_baskets=10), 1) == {("a",): 10, ("b",): 3}
    assert _as_dict(its.frequent_items(b, 0.31), 1) == {("a",): 10}


def test_triangle_is_not_a_candidate(spark):
    # AB and AC are frequent, BC is not: ABC must not be counted
    rows = []
    for i in range(3):
        rows += [(f"ab{i}", "A"), (f"ab{i}", "B")]
        rows += [(f"ac{i}", "A"), (f"ac{i}", "C")]
    rows += [("abc", "A"), ("abc", "B"), ("abc", "C")]
    m = mine_itemsets(_baskets(spark, rows), 3)
    assert _as_dict(m.pairs, 2) == {("A", "B"): 4, ("A", "C"): 4}
    assert its.candidate_triples(m.pairs).count() == 0
    assert m.triples.count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_match_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [f"i{j:02d}" for j in range(12)]
    rows = [(f"b{b}", rng.choice(items[: rng.randint(3, 12)])) for b in range(60) for _ in range(6)]
    support = 4
    m = mine_itemsets(_baskets(spark, rows), support)
    for k in (1, 2, 3):
        assert _as_dict(m.levels[k], k) == _brute(rows, support, k)


def test_monotonicity(spark):
    rng = random.Random(7)
    rows = [(f"b{b}", f"i{rng.randint(0, 8)}") for b in range(80) for _ in range(5)]
    m = mine_itemsets(_baskets(spark, rows), 3)
    s1, s2 = _as_dict(m.items, 1), _as_dict(m.pairs, 2)
    for (a, b), n in s2.items():
        assert n <= s1[(a,)] and n <= s1[(b,)]
    for (a, b, c), n in _as_dict(m.triples, 3).items():
        assert all(pair in s2 and n <= s2[pair] for pair in [(a, b), (a, c), (b, c)])


def test_top_itemsets_ties_are_stable(spark):
    rows = []
    for n, (a, b) in enumerate(combinations("abcdefg", 2)):
        rows += [(f"{a}{b}{i}", a) for i in range(3)] + [(f"{a}{b}{i}", b) for i in range(3)]
    m = mine_itemsets(_baskets(spark, rows), 3, max_k=2)
    dictionary = spark.createDataFrame([(c, c.upper()) for c in "abcdefg"], "item string, description string")
    top = its.top_itemsets(m.pairs, dictionary, 10).orderBy("rank").collect()
    assert [(r.item_1, r.item_2) for r in top] == list(combinations("abcdefg", 2))[:10]
    assert [r.rank for r in top] == list(range(1, 11))
    assert top[0].description_1 == "A" and top[0].description_2 == "B"


def test_item_dictionary_keeps_smallest_description(spark):
    df = spark.createDataFrame([("c1", "zeta"), ("c1", "alpha"), ("c2", "beta"), (None, "x")],
                               "code string, description string")
    d = {r.item: r.description for r in its.item_dictionary(df, "code", "description").collect()}
    assert d == {"c1": "alpha", "c2": "beta"}


def test_basket_itemlists_sorted(spark):
    b = _baskets(spark, [("b1", "z"), ("b1", "a"), ("b2", "a"), ("b2", "q")])
    lists = its.basket_itemlists(b, its.frequent_items(b, 2))
    assert {r.basket: r["items"] for r in lists.collect()} == {"b1": ["a"], "b2": ["a"]}


def test_agrees_with_fpgrowth(spark):
    from pyspark.ml.fpm import FPGrowth
    b = catalog.order_brand_baskets(spark, SF001)
    n = its.basket_count(b).first()["n_baskets"]
    support = 8
    m = mine_itemsets(b, support)
    lists = b.groupBy("basket").agg(F.collect_set("item").alias("items"))
    fp = FPGrowth(itemsCol="items", minSupport=(support - 0.5) / n).fit(lists).freqItemsets
    expected = {}
    for r in fp.collect():
        if len(r["items"]) <= 3:
            expected[tuple(sorted(r["items"]))] = r["freq"]
    got = {}
    for k in (1, 2, 3):
        got.update(_as_dict(m.levels[k], k))
    assert got == expected
