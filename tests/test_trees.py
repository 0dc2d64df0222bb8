"""M8 / M9: exact trees against a plain recursive one."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import trees

SCHEMA = "id int, a double, b double, c double, y double, fold int"
FEATURES = ["a", "b", "c"]


def brute(rows, criterion="squared_error", max_depth=60, min_split=2, depth=0):
    """(prediction, None) or (prediction, feature, threshold, left, right)."""
    ys = [r[-1] for r in rows]
    value = statistics.median(ys) if criterion == "absolute_error" else sum(ys) / len(ys)
    if depth == max_depth or len(rows) < min_split or len(set(ys)) == 1:
        return value, None
    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:]):
            left, right = [r[-1] for r in rows if r[f] <= lo], [r[-1] for r in rows if r[f] > lo]
            if criterion == "absolute_error":
                loss = sum(sum(abs(y - statistics.median(s)) for y in s) for s in (left, right))
            elif criterion == "friedman_mse":
                d = sum(left) / len(left) - sum(right) / len(right)
                loss = -(float(len(left)) * len(right) / len(rows) * d * d)
            else:
                loss = -(sum(left) * sum(left) / len(left) + sum(right) * sum(right) / len(right))
            m = (lo + hi) / 2
            if best is None or (loss, f, m) < best:
                best = (loss, f, m)
    if best is None:
        return value, None
    _, f, m = best
    sides = [[r for r in rows if (r[f] <= m) == is_left] for is_left in (True, False)]
    return (value, f, m, *[brute(s, criterion, max_depth, min_split, depth + 1) for s in sides])


def answer(tree, r):
    while tree[1] is not None:
        tree = tree[3] if r[tree[1]] <= tree[2] else tree[4]
    return tree[0]


def data(seed, n=160):
    rng = random.Random(seed)
    return [(i, float(rng.randrange(6)), round(rng.gauss(0, 3), 2), float(rng.choice([-1, 0, 1e6])),
             float(rng.choice([0, 0, 1, 1, 2, 5, 40])), i % 5) for i in range(n)]


@pytest.mark.parametrize("criterion", trees.CRITERIA)
@pytest.mark.parametrize("max_depth, min_split", [(60, 2), (3, 7), (0, 2)])
def test_tree_equals_brute_force(spark, criterion, max_depth, min_split):
    rows = data(len(criterion) + max_depth)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = trees.fit(df, FEATURES, "y", criterion, max_depth, min_split)
    want = brute([r[1:5] for r in rows], criterion, max_depth, min_split)
    probe = rows + [(900 + i, *[float(v) for v in np.random.default_rng(i).normal(0, 4, 3)], 0.0, 0) for i in range(50)]
    got = {r.id: r.prediction for r in trees.predict(spark.createDataFrame(probe, SCHEMA), model).collect()}
    assert got == pytest.approx({r[0]: answer(want, r[1:4]) for r in probe}, abs=1e-9)


def test_many_blocks_and_few_values_at_once(spark, monkeypatch):
    # values of a node over many blocks, labels over many chunks
    monkeypatch.setattr(trees, "VALUES_AT_ONCE", 3)
    rng = random.Random(3)
    rows = [(i, rng.random(), float(rng.randrange(500)), 1.0, float(rng.randrange(40)), 0) for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    for criterion in ("squared_error", "absolute_error"):
        model = trees.fit(df, FEATURES, "y", criterion, max_depth=2)
        want = brute([r[1:5] for r in rows], criterion, 2)
        got = {r.id: r.prediction for r in trees.predict(df, model).collect()}
        assert got == pytest.approx({r[0]: answer(want, r[1:4]) for r in rows}, abs=1e-9)


def test_ties_go_to_the_first_feature_and_the_lower_threshold(spark):
    rows = [(i, float(i), float(i), 0.0, float(y), 0) for i, y in enumerate([1, 0, 0, 1])]
    nodes = trees.fit(spark.createDataFrame(rows, SCHEMA), FEATURES, "y", max_depth=1).nodes
    root = nodes.where("node = 1").first()
    assert (root.feature, root.threshold) == (0, 0.5)


def test_a_cut_that_gains_nothing_is_made_for_the_nodes_below(spark):
    rows = [(i, float(a), float(b), 0.0, float(a ^ b), 0) for i, (a, b) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = trees.predict(df, trees.fit(df, FEATURES, "y")).collect()
    assert all(r.prediction == r.y for r in got)


def test_equal_rows_with_different_labels_end_in_one_leaf(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0, 3.0, float(i % 2), 0) for i in range(6)], SCHEMA)
    model = trees.fit(df, FEATURES, "y")
    assert model.n_nodes == 1 and {r.prediction for r in trees.predict(df, model).collect()} == {0.5}


def test_grid_equals_separate_fits(spark):
    rows = data(8, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.criterion, r.max_depth, r.min_samples_split): r.mean_mse
           for r in trees.grid_search(df, FEATURES, "y", depths=(1, 2, 4), min_splits=(2, 9, 30)).collect()}
    want = {}
    for criterion in trees.CRITERIA:
        for d in (1, 2, 4):
            for m in (2, 9, 30):
                errors = []
                for k in range(5):
                    tree = brute([r[1:5] for r in rows if r[5] != k], criterion, d, m)
                    errors.append(statistics.mean((r[4] - answer(tree, r[1:4])) ** 2 for r in rows if r[5] == k))
                want[criterion, d, m] = statistics.mean(errors)
    assert got == pytest.approx(want, abs=1e-9)
    best = trees.best_setting(trees.grid_search(df, FEATURES, "y", depths=(1, 2), min_splits=(2,)))
    assert set(best) == {"criterion", "max_depth", "min_samples_split"}


def test_unbroadcast_nodes_give_the_same(spark, monkeypatch):
    rows = data(12)
    df = spark.createDataFrame(rows, SCHEMA)
    a = {r.id: r.prediction for r in trees.predict(df, trees.fit(df, FEATURES, "y", max_depth=3)).collect()}
    monkeypatch.setattr(trees, "BROADCAST_NODES", -1)
    b = {r.id: r.prediction for r in trees.predict(df, trees.fit(df, FEATURES, "y", max_depth=3)).collect()}
    assert a == b


def test_arguments_are_checked(spark):
    df = spark.createDataFrame(data(1, 10), SCHEMA)
    for kw in ({"criterion": "gini"}, {"max_depth": 61}, {"min_samples_split": 1}):
        with pytest.raises(ValueError):
            trees.fit(df, FEATURES, "y", **kw)
    with pytest.raises(ValueError, match="leakage"):
        trees.fit(df, ["a", "y"], "y")


def test_absolute_errors():
    rng = np.random.default_rng(0)
    labels = np.array([0.0, 1.0, 4.0, 9.0])
    counts = rng.integers(0, 5, (40, 4)).astype(float)
    want = [0.0 if not c.sum() else np.abs(np.repeat(labels, c.astype(int)) - np.median(
        np.repeat(labels, c.astype(int)))).sum() for c in counts]
    assert np.allclose(trees.absolute_errors(labels, counts), want)


def test_the_sql_tree_is_finished_before_its_last_level(spark, sf_small):
    from zonecast.plans.oracle import TREE_LEVELS
    from zonecast.plans.queries_models import TREE_FEATURES, model_input

    train = model_input(spark, sf_small).where(F.col("split") == "train")
    assert trees.fit(train, TREE_FEATURES).depth < TREE_LEVELS
