"""Trees and forests from histograms against a plain recursive search, and against each other."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwise.operators import histogram_trees as ht

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(12)
    rows = []
    for i in range(900):
        a, b, c, d = rng.random(), float(rng.randint(0, 3)), rng.gauss(0, 1), float(rng.randint(0, 60))
        y = float(round(10 * a + 7 * (b > 1) * (c > 0.2) + d / 9 + rng.random()))
        rows.append((a, b, c, d, y, i % 4 > 0))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double, is_train boolean").repartition(5)
    stored = ht.numbered(df, FEATURES, "y")
    return stored, [tuple(r) for r in stored.select(*FEATURES, "y", "is_train", ht.ROW).collect()]


def plain_tree(rows, cuts, depth, may, node=1):
    """Nested search over all thresholds: {node: (weight, sum, feature, threshold)}; rows are (x, y, weight)."""
    n, s = sum(w for _, _, w in rows), sum(w * y for _, y, w in rows)
    best = (1e-12 * max(1, s * s / n), None)
    if node.bit_length() <= depth:
        for f in sorted(may(node)):
            for t in cuts[f]:
                left = [(y, w) for x, y, w in rows if x[f] <= t]
                ln, ls = sum(w for _, w in left), sum(w * y for y, w in left)
                if 0 < ln < n:
                    gain = ls * ls / ln + (s - ls) ** 2 / (n - ln) - s * s / n
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, float(t)))
    out = {node: (n, s, best[1])}
    if best[1]:
        f, t = best[1]
        out |= plain_tree([r for r in rows if r[0][f] <= t], cuts, depth, may, 2 * node)
        out |= plain_tree([r for r in rows if r[0][f] > t], cuts, depth, may, 2 * node + 1)
    return out


def held(forest, tree):
    return {i: (n, s, (f, float(forest.cuts[f][k])) if f >= 0 else None) for i, (n, s, f, k) in forest.nodes[tree].items()}


@pytest.mark.parametrize("local", [ht.LOCAL, 60, 0])
def test_trees_equal_a_plain_search_however_nodes_are_finished(spark, data, local):
    rows, plain = data
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [16])[16]
    forest = ht.fit(rows, FEATURES, "y", [0, 1, 5], 4, cuts, 3, local)
    for tree in (0, 1, 5):
        w = ht.weights(np.array([r[6] for r in plain]), tree, 3)
        of = [(r[:4], r[4], float(k)) for r, k in zip(plain, w) if r[5] and k]
        want = plain_tree(of, cuts, 4, lambda node: np.flatnonzero(ht.allowed(tree, np.array([node]), 4, 3)[0]).tolist())
        assert held(forest, tree) == want and len(want) > 12


def test_thresholds_are_quantiles(spark, data):
    rows, plain = data
    train = sorted(r[0] for r in plain if r[5])
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [8, 5])
    for bins in (8, 5):
        assert cuts[bins][0].tolist() == [train[math.ceil(i / bins * len(train)) - 1] for i in range(1, bins)]
    assert cuts[8][1].tolist() == [0.0, 1.0, 2.0, 3.0]


def test_first_trees_of_a_forest_and_cut_trees_are_smaller_forests(spark, data):
    rows, _ = data
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [32])[32]
    whole = ht.fit(rows, FEATURES, "y", range(9), 6, cuts, 8)
    grid = ht.errors(rows, whole, "y", (1, 3, 8), (2, 4, 6))
    for trees, depth in ((1, 4), (3, 2), (3, 6), (8, 4)):
        direct = ht.fit(rows, FEATURES, "y", [0] if trees == 1 else range(1, trees + 1), depth, cuts, 8).model(trees, depth)
        scored = direct.transform(rows).withColumn("e", F.pow(F.col("y") - F.col("prediction"), 2))
        mse = {r["is_train"]: r["m"] for r in scored.groupBy("is_train").agg(F.avg("e").alias("m")).collect()}
        assert math.isclose(mse[True], grid[trees, depth][0], rel_tol=1e-9)
        assert math.isclose(mse[False], grid[trees, depth][1], rel_tol=1e-9)
        assert direct.toDebugString == whole.model(trees, depth).toDebugString
    assert grid[8, 6][1] < grid[1, 2][1]


def test_bootstrap_weights_and_feature_subsets():
    w = ht.weights(np.arange(200_000), 4, 1)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - math.exp(-1)) < 0.005
    assert (ht.weights(np.arange(100), 5, 1) != w[:100]).any() and (ht.weights(np.arange(100), 0, 1) == 1).all()
    may = ht.allowed(3, np.arange(1, 3000), 19, 7)
    assert (may.sum(axis=1) == 7).all() and abs(may.mean(axis=0) - 7 / 19).max() < 0.05


def test_saved_and_printed_trees_score_alike(spark, data, tmp_path):
    rows, plain = data
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [16])[16]
    model = ht.fit(rows, FEATURES, "y", range(1, 4), 5, cuts, 2).model(3, 5)
    model.save(spark, str(tmp_path / "m"))
    back = ht.TreeModel.load(spark, str(tmp_path / "m"))
    printed = ht.parse_printed(model.toDebugString)
    x = np.array([r[:4] for r in plain])
    for a, b, c in zip(model.trees, back.trees, printed):
        want = a.value[a.leaves(x)]
        assert (b.value[b.leaves(x)] == want).all() and (c.value[c.leaves(x)] == want).all()
    assert back.features == FEATURES and len(printed) == 3
    with pytest.raises(ValueError):
        ht.parse_printed("If (feature 0 <= 1.0)\n Predict: 2.0\n")


def test_no_rows_one_row_and_equal_rows(spark):
    schema = "a double, y double, is_train boolean"
    for given, nodes in (([], 0), ([(1.0, 5.0, True)], 1), ([(1.0, 5.0, True)] * 9 + [(1.0, 7.0, False)], 1)):
        rows = ht.numbered(spark.createDataFrame(given, schema), ["a"], "y")
        cuts = ht.thresholds(rows.where("is_train"), ["a"], [4])[4]
        forest = ht.fit(rows, ["a"], "y", [0], 3, cuts, 1)
        assert len(forest.nodes[0]) == nodes
        train, test = ht.errors(rows, forest, "y", [1], [3])[1, 3]
        assert (math.isnan(train) if not given else train == 0) and (math.isnan(test) or test == 4)
