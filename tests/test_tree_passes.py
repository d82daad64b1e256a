"""Passes of the tree fits: all cores at work, thresholds searched once for all bin counts, one worker for several models."""

import numpy as np
import pandas as pd

from tripwise.operators import histogram_trees as ht

FEATURES = ["a", "b", "c", "d"]


def _rows(spark, n=3000):
    rng = np.random.default_rng(3)
    x = pd.DataFrame({"a": rng.random(n), "b": rng.integers(0, 7, n) / 7, "c": np.zeros(n), "d": rng.normal(size=n)})
    x["dur"] = np.floor(100 * x["a"] + 30 * x["b"] + 5 * rng.normal(size=n))
    x["is_train"] = rng.random(n) < 0.7
    return spark.createDataFrame(x)


def test_rows_of_one_task_are_read_by_all_cores(spark):
    rows = ht.numbered(_rows(spark).coalesce(1), FEATURES, "dur")
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in rows.select(ht.ROW).collect()) == list(range(3000))


def test_ranks_give_the_trees_of_the_rows(spark):
    rows = ht.numbered(_rows(spark), FEATURES, "dur")
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [5, 12, 32])
    ranks, every = ht.ranked(rows, FEATURES, "dur", cuts), ht.every_threshold(cuts)
    assert all((a == b).all() for a, b in zip(ranks.every, every))
    x = np.array([[*r] for r in rows.select(*FEATURES).collect()])
    at = ht._bins(x, every)
    for b, of in cuts.items():
        for f, table in enumerate(ht._tables(of, every)):
            assert (table[at[:, f]] == ht._bins(x, of)[:, f]).all()
        for local in (50, 100_000):  # histograms first, or whole trees where their rows meet
            plain = ht.fit(rows, FEATURES, "dur", [0, 1, 2], 6, of, 9, local)
            assert ht.fit(ranks, FEATURES, "dur", [0, 1, 2], 6, of, 9, local).nodes == plain.nodes
            assert all(len(plain.nodes[t]) > 20 for t in range(3))


def test_several_models_are_scored_by_one_worker(spark):
    rows = ht.numbered(_rows(spark), FEATURES, "dur")
    cuts = ht.thresholds(rows.where("is_train"), FEATURES, [8])[8]
    forest = ht.fit(rows, FEATURES, "dur", [1, 2], 3, cuts, 1).model(2, 3)
    df = forest.transform(rows, "both")
    for i, t in enumerate(forest.trees):
        df = ht.TreeModel(FEATURES, [t]).transform(df, f"tree_{i}")
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert df.where("abs(both - (tree_0 + tree_1) / 2) > 1e-9").count() == 0
