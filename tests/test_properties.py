"""Property tests: random small inputs against brute force (hypothesis)."""

from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import exact
from tessera.operators import itemsets as its
from tessera.plans.market_basket import mine_itemsets

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

baskets_strategy = st.lists(
    st.tuples(st.integers(0, 14), st.sampled_from(list("abcdefgh"))), min_size=1, max_size=80)


@SETTINGS
@given(rows=baskets_strategy, support=st.integers(1, 4))
def test_itemsets_equal_brute_force(spark, rows, support):
    by_basket = {}
    for b, i in rows:
        by_basket.setdefault(b, set()).add(i)
    df = spark.createDataFrame([(str(b), i) for b, i in rows], "basket string, item string")
    m = mine_itemsets(its.basket_distinct(df), support)
    for k in (1, 2, 3):
        want = {}
        for items in by_basket.values():
            for c in combinations(sorted(items), k):
                want[c] = want.get(c, 0) + 1
        want = {c: n for c, n in want.items() if n >= support}
        cols = ["item"] if k == 1 else [f"item_{j}" for j in range(1, k + 1)]
        got = {tuple(r[c] for c in cols): r["support"] for r in m.levels[k].collect()}
        assert got == want


sets_strategy = st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=12), min_size=2, max_size=14)


@SETTINGS
@given(sets=sets_strategy, threshold=st.sampled_from([0.3, 0.5, 0.7, 0.85, 1.0]))
def test_prefix_filter_join_is_exact(spark, sets, threshold):
    rows = [(i, sorted(s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "doc_id long, shingles array<long>")
    got = {(r.first, r.second) for r in exact.exact_similar_pairs(df, threshold).collect()}
    want = {(a, b) for (a, x), (b, y) in combinations(rows, 2)
            if len(set(x) & set(y)) / len(set(x) | set(y)) >= threshold}
    assert got == want
