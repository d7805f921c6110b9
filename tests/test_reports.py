import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from cartwheel.operators.itemsets import association_rules, frequent_itemsets, largest_itemsets, mine, order_baskets
from cartwheel.operators.profile import distinct_profile, null_profile, percentiles
from cartwheel.operators.runs import champions, mark_best, metrics_long

POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p0": 0.0, "p100": 1.0}


def test_percentiles_interpolate_also_with_a_hot_value(spark):
    rng = np.random.default_rng(4)
    groups = {
        "hot": np.concatenate([np.full(400, 3.25), rng.normal(size=800)]),
        "two": np.array([1.0, 2.0]),
        "one": np.array([7.0]),
        "ties": np.array([1.0, 1.0, 5.0, 5.0, 5.0]),
    }
    rows = [(g, float(x)) for g, values in groups.items() for x in values] + [("two", None)]
    frame = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in percentiles(frame, "g", "x", POINTS).collect()}
    for g, values in groups.items():
        assert [got[g][p] for p in POINTS] == pytest.approx([np.percentile(values, 100 * q) for q in POINTS.values()])
        assert got[g]["mean"] == pytest.approx(values.mean()) and got[g]["n_values"] == len(values)


def test_profiles(spark):
    frame = spark.createDataFrame([(1, None), (2, "a"), (2, None)], "i int, s string")
    assert null_profile(frame).first().asDict() == {"i": 0, "s": 2}
    assert distinct_profile(frame, ["i", "s"]).first().asDict() == {"distinct_i": 2, "distinct_s": 1}


def test_champion_needs_a_strictly_lower_error(spark):
    errors = [3.0, 3.0, 2.5, None, 2.6, 2.4]
    frame = spark.createDataFrame([("m", n, e) for n, e in enumerate(errors)], "model string, run int, rmse double")
    rows = champions(frame, "model", "run", "rmse").orderBy("run").collect()
    assert [r.is_best for r in rows] == [True, False, True, False, False, True]
    assert [r.champion for r in rows] == [0, 0, 2, 2, 2, 5]
    missing = spark.createDataFrame([("m", 0, None), ("m", 1, 9.0)], "model string, run int, rmse double")
    assert [r.champion for r in champions(missing, "model", "run", "rmse").orderBy("run").collect()] == [0, 1]


def test_best_steps(spark):
    frame = spark.createDataFrame([("r", n, x) for n, x in enumerate([2.0, 1.0, 1.0, 0.5])], "run string, step int, e double")
    assert [r.is_best for r in mark_best(frame, "run", "step", "e").orderBy("step").collect()] == [True, True, False, True]


def test_metrics_long(spark):
    frame = spark.createDataFrame([("r", 1, 0.5, 7)], "run string, step int, a double, b int")
    rows = {(r.run_id, r.step, r.name, r.value) for r in metrics_long(frame, "run", "step", ["a", "b"]).collect()}
    assert rows == {("r", 1, "a", 0.5), ("r", 1, "b", 7.0)}


def test_itemsets_and_rules(spark):
    baskets = {1: "abc", 2: "ab", 3: "ab", 4: "c", 5: "aab"}
    rows = [(o, i) for o, items in baskets.items() for i in items] + [(6, None)]
    frame = order_baskets(spark.createDataFrame(rows, "order_id long, item_id string"))
    assert {r.order_id: "".join(r["items"]) for r in frame.collect()} == {1: "abc", 2: "ab", 3: "ab", 4: "c", 5: "ab"}
    model = mine(frame, 0.4, 0.5)
    sets = {"".join(r["items"]): r.freq for r in frequent_itemsets(model).collect()}
    assert sets == {"a": 4, "b": 4, "ab": 4, "c": 2}
    assert largest_itemsets(model, 1).first()["items"] == ["a", "b"]
    rules = {("".join(r.antecedent), r.consequent): r.confidence for r in association_rules(model).collect()}
    assert rules == {("a", "b"): 1.0, ("b", "a"): 1.0}


def test_itemsets_match_all_subsets(spark):
    rng = random.Random(2)
    baskets = [sorted(rng.sample(range(9), rng.randint(1, 6))) for _ in range(120)] + [[1, 2, 3, 4, 5, 6, 7, 8]] * 5
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "order_id long, items array<int>")
    mined = mine(frame, 0.06, 0.3)
    counts = Counter(s for b in baskets for k in range(1, len(b) + 1) for s in itertools.combinations(b, k))
    frequent = {s: n for s, n in counts.items() if n >= math.ceil(0.06 * len(baskets))}
    assert {tuple(r["items"]): r.freq for r in frequent_itemsets(mined).collect()} == frequent
    rules = {
        (s[:i] + s[i + 1 :], x): n / frequent[s[:i] + s[i + 1 :]]
        for s, n in frequent.items() if len(s) > 1
        for i, x in enumerate(s) if n / frequent[s[:i] + s[i + 1 :]] >= 0.3
    }
    found = {(tuple(r.antecedent), r.consequent): (r.confidence, r.lift, r.support) for r in association_rules(mined).collect()}
    assert {k: v[0] for k, v in found.items()} == pytest.approx(rules)
    for (_, x), (confidence, lift, _) in found.items():
        assert lift == pytest.approx(confidence / (frequent[x,] / len(baskets)))


def test_itemsets_of_empty_baskets(spark):
    frame = spark.createDataFrame([], "order_id long, items array<int>")
    assert frequent_itemsets(mine(frame)).count() == association_rules(mine(frame)).count() == 0
