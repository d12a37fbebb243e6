import math

from pyspark.sql import functions as F

from tessera.operators import itemsets as its
from tessera.operators import rules as rl
from tessera.plans.market_basket import mine_itemsets, rules_for


def _mined(spark, rows, support):
    b = its.basket_distinct(spark.createDataFrame(rows, "basket string, item string"))
    return mine_itemsets(b, support)


def _expected_metrics(c, l, h, n):
    conf = c / l
    lift = n * conf / h
    lo = max((l + h) / n - 1, 1 / n) / (l * h / n ** 2)
    hi = n / max(l, h)
    std = None if hi == lo else (lift - lo) / (hi - lo)
    return conf, conf - h / n, lift, std


def test_rule_generation_single_item_rhs(spark):
    df = spark.createDataFrame([("a", "b", "c", 5)], "item_1 string, item_2 string, item_3 string, support long")
    rules = {(tuple(r.lhs), r.rhs) for r in rl.rule_generation(df).collect()}
    assert rules == {(("b", "c"), "a"), (("a", "c"), "b"), (("a", "b"), "c")}


def test_metrics_match_formulas(spark):
    rows = []
    for i in range(10):
        rows.append((f"b{i}", "x"))
        if i < 6:
            rows.append((f"b{i}", "y"))
        if i < 4:
            rows.append((f"b{i}", "z"))
    rows += [("e1", "y"), ("e2", "z"), ("e3", "q")]
    m = _mined(spark, rows, 2)
    n = 13
    supports = {"x": 10, "y": 7, "z": 5}
    pair = {("x", "y"): 6, ("x", "z"): 4, ("y", "z"): 4}
    scored = rl.scored_rules(m.pairs, m.items, [m.items], m.n_baskets()).collect()
    assert len(scored) == 6
    for r in scored:
        (lhs,) = r.lhs
        c = pair[tuple(sorted((lhs, r.rhs)))]
        conf, interest, lift, std = _expected_metrics(c, supports[lhs], supports[r.rhs], n)
        assert (r.rule_count, r.lhs_count, r.rhs_count) == (c, supports[lhs], supports[r.rhs])
        assert math.isclose(r.confidence, conf) and math.isclose(r.interest, interest)
        assert math.isclose(r.lift, lift) and math.isclose(r.std_lift, std)
    triples = rl.scored_rules(m.triples, m.items, [m.items, m.pairs], m.n_baskets()).collect()
    for r in triples:
        assert r.rule_count == 4 and r.lhs_count == pair[tuple(r.lhs)]


def test_universal_item_gives_null_std_lift(spark):
    # "u" is in every basket: upper == lower for rules with u, std lift is NULL, no error
    rows = [(f"b{i}", "u") for i in range(6)] + [(f"b{i}", "v") for i in range(3)]
    m = _mined(spark, rows, 2)
    scored = rl.scored_rules(m.pairs, m.items, [m.items], m.n_baskets()).collect()
    assert scored and all(r.std_lift is None for r in scored)
    assert rules_for(m, 0.0).count() == 0


def test_association_rules_sorted_and_filtered(spark):
    rows = [(f"b{i}", it) for i in range(20) for it in ("a", "b") if i < 8] + \
           [(f"c{i}", "a") for i in range(5)] + [(f"d{i}", "c") for i in range(9)] + \
           [(f"b{i}", "c") for i in range(2)]
    m = _mined(spark, rows, 2)
    rules = rules_for(m, 0.1).collect()
    lifts = [r.std_lift for r in rules]
    assert lifts == sorted(lifts, reverse=True) and all(x >= 0.1 for x in lifts)


def test_rule_lines_format(spark):
    rules = spark.createDataFrame(
        [(["a", "b"], "c", 1, 2, 3, 0.5, 0.25, 1.5, 0.125)],
        "lhs array<string>, rhs string, rule_count long, lhs_count long, rhs_count long, "
        "confidence double, interest double, lift double, std_lift double")
    d = spark.createDataFrame([("a", "Alpha"), ("b", "Beta"), ("c", "Gamma")], "item string, description string")
    line = rl.rule_lines(rules, d).select("line").first()[0]
    assert line == "{Alpha, Beta} -> {Gamma}: 0.125000, 1.500000, 0.500000, 0.250000"
    one = rules.withColumn("lhs", F.array(F.lit("a")))
    assert rl.rule_lines(one, d).first().line.startswith("{Alpha} -> {Gamma}: ")


def test_standardised_lift_is_null_for_universal_items(spark):
    """An item in every basket leaves no range for the lift, whatever the numbers."""
    rows = [(n, h, h) for n in range(1, 61) for h in range(1, n)]
    df = spark.createDataFrame(rows, "n long, rule_count long, rhs_count long").withColumn("lhs_count", F.col("n"))
    out = rl.rule_metrics(df, F.col("n"))
    assert out.filter("std_lift IS NOT NULL").count() == 0


def test_standardised_lift_equals_its_definition(spark):
    from fractions import Fraction

    rows = [(n, l, h, c) for n in (7, 10, 13) for l in range(1, n) for h in range(1, n)
            for c in range(max(l + h - n, 1), min(l, h) + 1)]
    df = spark.createDataFrame(rows, "n long, lhs_count long, rhs_count long, rule_count long")
    for r in rl.rule_metrics(df, F.col("n")).collect():
        n, l, h, c = r.n, r.lhs_count, r.rhs_count, r.rule_count
        lift, bound = Fraction(n * c, l * h), Fraction(n * n, l * h)
        lower, upper = max(Fraction(l + h, n) - 1, Fraction(1, n)) * bound, Fraction(n, max(l, h))
        assert (r.std_lift is None) == (upper == lower)
        if r.std_lift is not None:
            assert abs(r.std_lift - float((lift - lower) / (upper - lower))) < 1e-12


def test_rule_lines_are_ordered_and_keep_unlabelled_items(spark, tmp_path):
    from tessera.sources import sinks

    rules = spark.createDataFrame(
        [(["a", "b"], "c", 1, 1, 1, 0.5, 0.1, 1.0, x / 100) for x in range(100)]
        + [(["a"], "b", 1, 1, 1, 0.5, 0.1, 1.0, 2.0)],
        "lhs array<string>, rhs string, rule_count long, lhs_count long, rhs_count long, "
        "confidence double, interest double, lift double, std_lift double").repartition(7)
    dictionary = spark.createDataFrame([("a", None), ("b", "B")], "item string, description string")
    sinks.write_rule_lines(rl.rule_lines(rules, dictionary), str(tmp_path / "lines"))
    parts = sorted(p for p in (tmp_path / "lines").iterdir() if p.name.startswith("part-"))
    lines = [x for p in parts for x in p.read_text().splitlines()]
    assert lines[0].startswith("{a} -> {B}: 2.000000") and len(lines) == 101
    assert all(x.startswith("{a, B} -> {c}: ") for x in lines[1:])
    lifts = [float(x.split(": ")[1].split(",")[0]) for x in lines]
    assert lifts == sorted(lifts, reverse=True)
