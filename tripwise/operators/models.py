"""Tree, forest and linear regressors; grid search; best-cell choice.

A grid takes one frame whose ``is_train`` flag tells the halves of the split, stores it once,
and needs one forest for each bin count (``histogram_trees``): its prefixes and cuts are the cells of all sizes
and depths, scored in one pass that yields train and test MSE together.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from threading import Lock
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.operators import histogram_trees as ht
from tripwise.operators.clustering import CentreModel
from tripwise.operators.linear import LR_ITERATIONS, LR_STEPS, LinearModel, Moments, descend, moments_by
from tripwise.sources.ledger import Ledger, key_of

# Fixed values of the source's grids.
DT_DEPTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16)
DT_BINS = (8, 16, 24, 32, 48, 64, 96, 128, 256, 512)
RF_TREES = (1, 2, 4, 6, 8, 10, 16, 32, 64, 128)
RF_DEPTHS = (2, 3, 4, 5, 6, 7, 8, 10)
RF_BINS = (16, 32, 48, 64, 96, 128, 256)


def flagged(train: DataFrame, test: DataFrame | None) -> DataFrame:
    """One frame with ``is_train``; without ``test``, ``train`` is that frame already (and is computed once)."""
    if test is None:
        return train
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


def fit_tree(train: DataFrame, features: Sequence[str], label: str = "dur", max_depth: int = 5,
             max_bins: int = 32, seed: int = 42) -> ht.TreeModel:
    """One tree over all rows and features."""
    return fit_forest(train, features, label, 1, max_depth, max_bins, seed)


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "dur", num_trees: int = 16,
               max_depth: int = 5, max_bins: int = 32, seed: int = 42) -> ht.TreeModel:
    """Forest: several trees draw rows with replacement and split on a third of the features; one
    tree sees every row once and all features, like the source's trainer."""
    rows = ht.numbered(train.withColumn("is_train", F.lit(True)), features, label)
    cuts = ht.thresholds(rows, features, [max_bins])[max_bins]
    trees = [0] if num_trees == 1 else range(1, num_trees + 1)
    return ht.fit(rows, features, label, trees, max_depth, cuts, seed).model(num_trees, max_depth)


def predict(model, df: DataFrame, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """Add ``out``: a column expression for linear models, batches through the trees otherwise."""
    return model.transform(df, out)


RESULT_SCHEMA = ("cell int, algo string, num_trees int, max_depth int, max_bins int, iterations int, "
                 "step double, train_mse double, test_mse double")


def grid_argmin(results: DataFrame, metric: str = "test_mse", order: str = "cell") -> DataFrame:
    """Best cell: smallest metric, earliest cell on ties; NaN / NULL never win."""
    ok = F.col(metric).isNotNull() & ~F.isnan(metric)
    return results.where(ok).orderBy(F.col(metric), F.col(order)).limit(1)


def grid_search(spark: SparkSession, algo: str, train: DataFrame, test: DataFrame | None, features: Sequence[str],
                label: str = "dur", cells: list[dict] | None = None, seed: int = 42, parallelism: int = 4,
                journal: Ledger | None = None):
    """Score every cell on both halves, choose by test MSE (``train`` and ``test``, or one frame with ``is_train``).

    A ``journal`` keeps what is finished under the data and the parameters (of trees: the numbered rows, the thresholds,
    and for each bin count the errors of its cells and its best model), so a search that begins again with the same ones
    does the rest only.  The linear grid is one pass and begins anew.

    Returns (best model or None, results DataFrame, best cell dict or None).
    """
    algo = algo.lower()
    cells = cells if cells is not None else default_cells(algo)
    both = flagged(train, test)
    if algo == "lr":
        return _grid_linear(spark, both, features, label, cells)
    path, key = journal and f"{journal.path}-rows-{uuid.uuid4().hex}", ""
    rows = ht.numbered(both, features, label, path)
    if journal is not None:
        rows, key = journal.same_rows(rows, path, [*features, label, "is_train"])
    return _grid_trees(spark, algo, rows, features, label, cells, seed, parallelism, journal, key)


def _grid_trees(spark, algo, rows, features, label, cells, seed, parallelism, journal=None, data=""):
    """One forest a bin count, as deep and with as many trees as its cells ask for; one pass scores them all."""
    groups: dict[int, list[int]] = {}
    for i, c in enumerate(cells):
        groups.setdefault(int(c["max_bins"]), []).append(i)
    size, depth = (lambda i: int(cells[i].get("num_trees", 1))), (lambda i: int(cells[i]["max_depth"]))
    cuts = _kept_thresholds(rows, features, list(groups), journal, data)

    def kept_key(bins, idxs):
        return key_of(data=data, features=list(features), label=label, seed=seed, bins=bins, all_bins=sorted(groups),
                      cells=[(size(i), depth(i)) for i in idxs])

    done = journal is not None and all(journal.get(kept_key(*item)) for item in groups.items())
    ranks = None if done else ht.ranked(rows, features, label, cuts)

    def run(item):
        bins, idxs = item
        sizes, depths = {size(i) for i in idxs}, {depth(i) for i in idxs}
        key = kept_key(bins, idxs)
        if journal is not None and (kept := journal.get(key)):
            scored = dict(zip(idxs, map(tuple, kept["scored"])))
            return scored, (scored[idxs[kept["best"]]][1], idxs[kept["best"]], kept["model"]) if kept["model"] else None
        trees = [0] * (1 in sizes) + list(range(1, max(sizes) + 1 if max(sizes) > 1 else 1))
        forest = ht.fit(ranks, features, label, trees, max(depths), cuts[bins], seed)
        mse = ht.errors(ranks, forest, label, sizes, depths)
        scored = {i: mse[size(i), depth(i)] for i in idxs}
        fine = [(tem, i) for i, (_, tem) in scored.items() if not math.isnan(tem)]
        # Of each bin count only the best cell's trees stay on the driver (with a journal: its path).
        best = (*min(fine), forest.model(size(min(fine)[1]), depth(min(fine)[1]))) if fine else None
        if journal is not None:
            path = save_model(spark, best[2], f"{journal.path}-model-{key[:16]}") if best else None
            with lock:
                journal.put(key, dict(scored=[scored[i] for i in idxs], best=best and idxs.index(best[1]), model=path))
            best = best and (*best[:2], path)
        return scored, best

    lock = Lock()
    workers = max(1, parallelism) if all(size(i) == 1 for i in range(len(cells))) else 1  # a forest keeps all tasks busy
    with ThreadPoolExecutor(max_workers=workers) as pool:
        parts = list(pool.map(run, list(groups.items())))
    scored = {i: mse for part, _ in parts for i, mse in part.items()}
    out = [(i, algo, c.get("num_trees"), int(c["max_depth"]), int(c["max_bins"]), None, None, *scored[i])
           for i, c in enumerate(cells)]
    best, results, cell = _choose(spark, out, {best[1]: best[2] for _, best in parts if best}, cells)
    return load_model(spark, best, algo) if isinstance(best, str) else best, results, cell


def _kept_thresholds(rows, features, bins, journal, data):
    """Thresholds of all bin counts.  A journal keeps them: sketches of a second run need not be equal to the bit."""
    key = key_of(data=data, features=list(features), thresholds=sorted(bins))
    if journal is None or (kept := journal.get(key)) is None:
        cuts = ht.thresholds(rows.where("is_train"), features, bins)
        if journal is not None:
            journal.put(key, {str(b): [c.tolist() for c in of] for b, of in cuts.items()})
        return cuts
    return {int(b): [np.array(c, float) for c in of] for b, of in kept.items()}


def _grid_linear(spark, both, features, label, cells):
    by = moments_by(both, "is_train", list(features), label)
    empty = Moments(np.zeros((len(features), len(features))), np.zeros(len(features)), 0.0, 0)
    m_train, m_test = by.get(True, empty), by.get(False, empty)
    models, rows = {}, []
    by_step: dict[float, list[int]] = {}
    for c in cells:
        by_step.setdefault(float(c["step"]), []).append(int(c["iterations"]))
    paths = {s: descend(m_train, s, its) for s, its in by_step.items()}
    for i, c in enumerate(cells):
        w, _ = paths[float(c["step"])][int(c["iterations"])]
        models[i] = LinearModel(list(features), w.tolist())
        rows.append((i, "lr", None, None, None, int(c["iterations"]), float(c["step"]),
                     m_train.mse(w), m_test.mse(w)))
    return _choose(spark, rows, models, cells)


def _choose(spark, rows, models, cells):
    results = spark.createDataFrame(rows, RESULT_SCHEMA)
    best = grid_argmin(results).first()
    if best is None:
        return None, results, None
    return models[best["cell"]], results, cells[best["cell"]]


def default_cells(algo: str) -> list[dict]:
    if algo == "dt":
        return [dict(max_depth=d, max_bins=b) for d, b in product(DT_DEPTHS, DT_BINS)]
    if algo == "rf":
        return [dict(num_trees=t, max_depth=d, max_bins=b) for t, d, b in product(RF_TREES, RF_DEPTHS, RF_BINS)]
    if algo == "lr":
        return [dict(iterations=n, step=s) for n, s in product(LR_ITERATIONS, LR_STEPS)]
    raise ValueError(f"algo must be dt, rf or lr, not {algo!r}")


def save_model(spark: SparkSession, model, path: str) -> str:
    model.save(spark, path)
    return path


def load_model(spark: SparkSession, path: str, algo: str):
    kinds = {"lr": LinearModel, "dt": ht.TreeModel, "rf": ht.TreeModel, "km": CentreModel}
    if algo.lower() not in kinds:
        raise ValueError(f"algo must be one of {sorted(kinds)}, not {algo!r}")
    return kinds[algo.lower()].load(spark, path)
