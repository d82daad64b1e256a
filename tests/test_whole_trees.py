"""Trees grown whole where their rows are held: the same as trees of a level a pass, with no row sent."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripwise.operators import histogram_trees as ht
from tripwise.session import COMPILED, compiled_methods

FEATURES = ["a", "b", "c", "d"]


def _table(n, whole=True):
    rng = np.random.default_rng(5)
    x = pd.DataFrame({"a": rng.random(n), "b": rng.integers(0, 7, n) / 7, "c": np.zeros(n), "d": rng.normal(size=n)})
    x["dur"] = 100 * x["a"] - 30 * x["b"] + 5 * rng.normal(size=n)
    x["dur"] = np.floor(x["dur"]) if whole else x["dur"]
    x["is_train"] = rng.random(n) < 0.7
    return x


@pytest.mark.parametrize("labels,width", [("whole", 32), ("whole", 300), ("parts", 32), ("huge", 32)])
@pytest.mark.parametrize("tree", [0, 3])
def test_records_grow_the_tree_of_a_level_at_a_time(monkeypatch, labels, width, tree):
    monkeypatch.setattr(ht, "FEW", 40)
    monkeypatch.setattr(ht, "BLOCK", 256)
    x = _table(5000, labels != "parts")
    x["dur"] *= 1e9 if labels == "huge" else 1
    y, row = x["dur"].to_numpy(), np.arange(5000) * 7
    bins = np.random.default_rng(1).integers(0, width, (5000, 4)).astype(np.uint16)
    bins[:, 0] = np.floor(x["a"] * width)
    held = ht.Records(5000, 4, width)
    for a in range(0, 5000, 900):
        held.add(bins[a:a + 900], y[a:a + 900], row[a:a + 900])
    assert held.shared == (labels == "whole")
    w = ht.weights(row, tree, 2)
    want = {i: (n, s, f, k if f >= 0 else 0) for i, n, s, f, k in ht.grow(bins[w > 0], y[w > 0], w[w > 0], 1, 7, tree, 2, width)}
    for _ in range(2):  # the space of one tree serves the next
        got = {i: (n, s, f, k if f >= 0 else 0) for i, n, s, f, k in held.grow(tree, 7, 2)}
        assert got.keys() == want.keys() and len(want) > 100
        for i, (n, s, f, k) in want.items():
            assert (got[i][0], *got[i][2:]) == (n, f, k) and got[i][1] == (pytest.approx(s) if labels == "parts" else s)


def test_whole_trees_are_those_of_the_passes_and_score_alike(spark, monkeypatch):
    x = spark.createDataFrame(_table(4000)).withColumn("d", F.expr("if(a < 0.02, double('NaN'), d)"))
    rows = ht.numbered(x, FEATURES, "dur")
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [5, 32])
    ranks, trees = ht.ranked(rows, FEATURES, "dur", cuts), range(spark.sparkContext.defaultParallelism + 3)
    taken, whole_trees = [], ht._whole_trees
    monkeypatch.setattr(ht, "_whole_trees", lambda *a: taken.append(a) or whole_trees(*a))
    for b, of in cuts.items():
        whole = ht.fit(ranks, FEATURES, "dur", trees, 6, of, 4)
        assert len(taken) == 1
        monkeypatch.setattr(ht, "HELD", 0)  # rows that no task can hold
        passes = ht.fit(ranks, FEATURES, "dur", trees, 6, of, 4, 300)
        assert len(taken) == 1
        shape = lambda f: {t: {i: (n, s, j, k if j >= 0 else 0) for i, (n, s, j, k) in of.items()} for t, of in f.nodes.items()}
        assert shape(whole) == shape(passes) and all(len(of) > 20 for of in whole.nodes.values())
        plain, ranked = (ht.errors(r, whole, "dur", (1, 2, 8), (1, 3, 6)) for r in (rows, ranks))
        assert ranked.keys() == plain.keys()
        for cell, want in plain.items():
            assert ranked[cell] == pytest.approx(want, rel=1e-12)
            scored = whole.model(*cell).transform(rows).selectExpr("is_train", "pow(dur - prediction, 2) as e").toPandas()
            assert want == pytest.approx([scored.e[scored.is_train == half].mean() for half in (True, False)], rel=1e-9)
        monkeypatch.undo()
        taken.clear()
        monkeypatch.setattr(ht, "_whole_trees", lambda *a: taken.append(a) or whole_trees(*a))


def test_trees_are_dealt_once_and_evenly():
    parts = ht._dealt(range(129), 19, 8)
    assert sorted(t for p in parts for t in p) == list(range(129)) and max(map(len, parts)) <= 17
    assert ht._dealt([4, 2], 19, 8) == [[2], [4]]


def test_weights_are_poisson_numbers_of_the_hash():
    rows = np.arange(50_000)
    u = (ht._hashed(9, 3, rows) >> np.uint64(11)).astype(float) / (1 << 53)
    assert (ht.weights(rows, 3, 9) == np.searchsorted(ht.POISSON, u, "right")).all()


def test_sketches_of_some_features_at_a_time_are_those_of_all(spark, monkeypatch):
    rows = spark.createDataFrame(_table(2000))
    some = ht.thresholds(rows, FEATURES * 2, [8, 12])
    monkeypatch.setattr(ht, "SKETCHES", 100)
    for b, of in ht.thresholds(rows, FEATURES, [8, 12]).items():
        assert all((x == y).all() for x, y in zip(some[b], of * 2))


def test_method_limit_holds_in_its_block_only(spark):
    name, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        for given, within in ((65535, COMPILED), (500, 500)):
            spark.conf.set(name, str(given))
            with pytest.raises(KeyError), compiled_methods(spark):
                assert int(spark.conf.get(name)) == within
                raise KeyError
            assert int(spark.conf.get(name)) == given
    finally:
        spark.conf.set(name, before)
