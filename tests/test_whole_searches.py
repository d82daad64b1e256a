"""Registered searches are the operators' whole searches, not samples of them."""

import pytest

from conftest import SF_SMALL
from tripwise.checks import queries
from tripwise.operators import clustering, models
from tripwise.plans import pipeline


class Asked(Exception):
    """Carries what a query asks for, before the work begins."""


@pytest.mark.parametrize("name", ["train_test_predict", "train_test_predict_taxi_lr"])
def test_end_to_end_queries_search_all_of_k_and_all_cells(spark, monkeypatch, name):
    def run(*args):
        raise Asked(args[-1])
    monkeypatch.setattr(pipeline, "run", run)
    with pytest.raises(Asked) as got:
        queries()[name](spark, SF_SMALL)
    opts = got.value.args[0]
    assert (opts.k_grid, opts.restarts, opts.kmeans_iter) == (clustering.K_GRID, clustering.RESTARTS, clustering.MAX_ITER)
    assert opts.cells is None or opts.cells == models.default_cells("lr" if name.endswith("lr") else "dt")


@pytest.mark.parametrize("name,algo,count", [("grid_dt", "dt", 100), ("grid_rf", "rf", 560)])
def test_grid_queries_ask_for_every_cell(spark, monkeypatch, name, algo, count):
    def search(spark, algo, train, test, features, label="dur", cells=None, seed=42, **more):
        raise Asked(algo, models.default_cells(algo) if cells is None else cells)
    monkeypatch.setattr(models, "grid_search", search)
    with pytest.raises(Asked) as got:
        queries()[name](spark, SF_SMALL)
    assert got.value.args == (algo, models.default_cells(algo))
    assert len(got.value.args[1]) == count
