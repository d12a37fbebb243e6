import random
from itertools import combinations

from tessera.operators.joins import pairs_within_groups


def test_pairs_within_groups_grid_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(g, x, x * 10) for g in range(6) for x in rng.sample(range(500), rng.choice([1, 2, 9, 40]))]
    df = spark.createDataFrame(rows, "g int, x long, w long")
    want = set()
    for g in range(6):
        members = sorted((x, w) for gg, x, w in rows if gg == g)
        want |= {(g, a, b, wa, wb) for (a, wa), (b, wb) in combinations(members, 2)}
    for cell in (1, 4, 2048):
        got = [(r.g, r.first, r.second, r.w_1, r.w_2)
               for r in pairs_within_groups(df, ["g"], "x", carry=["w"], cell=cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_pairs_across_groups_grid_equals_brute_force(spark):
    from tessera.operators.joins import pairs_across_groups

    rng = random.Random(5)
    members = [(g, x) for g in range(5) for x in rng.sample(range(1000), [1, 3, 9, 17, 2][g])]
    pairs = [(0, 3, 0.5), (1, 3, 0.9), (2, 3, 0.7), (1, 2, 0.8), (3, 4, 1.0)]
    mdf = spark.createDataFrame(members, "g long, x long")
    pdf = spark.createDataFrame(pairs, "first long, second long, sim double")
    by = {}
    for g, x in members:
        by.setdefault(g, []).append(x)
    want = {(a, b, s, x1, x2) for a, b, s in pairs for x1 in by[a] for x2 in by[b]}
    for cell in (1, 4, 2048):
        got = [(r.first, r.second, r.sim, r._x1, r._x2)
               for r in pairs_across_groups(pdf, mdf, "g", "x", cell=cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want
