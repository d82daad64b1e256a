"""Scratch tables go with the block they were written in."""

import os

import pytest

from conftest import SF_SMALL
from tripwise.checks import ml
from tripwise.plans import pipeline
from tripwise.session import checkpoint_root, scratch_path, scratch_space, stored
from tripwise.sources import standins as sv


def files_below(folder: str) -> set[str]:
    return {os.path.join(d, f) for d, _, names in os.walk(folder.removeprefix("file:")) for f in names}


def test_scratch_goes_and_results_stay(spark):
    kept = scratch_path(spark, "kept")
    with scratch_space(spark) as outer:
        a = stored(spark.range(10), "a")
        with scratch_space(spark) as inner:
            assert inner.startswith(outer)
            b = stored(a.selectExpr("id * 2 as id"), "b")
            assert files_below(inner) and b.count() == 10
            result = stored(b, "result", kept)
        assert not files_below(inner) and a.count() == 10
        assert scratch_path(spark, "next").startswith(outer)
    assert not files_below(outer) and not scratch_path(spark, "next").startswith(outer)
    assert sorted(r.id for r in result.collect()) == list(range(0, 20, 2))


def test_scratch_goes_when_the_block_fails(spark):
    with pytest.raises(ValueError):
        with scratch_space(spark) as space:
            stored(spark.range(3), "a")
            assert files_below(space)
            raise ValueError
    assert not files_below(space) and not scratch_path(spark, "next").startswith(space)


def test_an_unused_space_is_no_error(spark):
    with scratch_space(spark) as space:
        pass
    assert not files_below(space)


def test_a_run_leaves_its_model_and_output_only(spark):
    events = sv.table(spark, SF_SMALL, "events")
    weather, trips = sv.weather(events), sv.trips(events)
    dirs = scratch_path(spark, "model"), scratch_path(spark, "clusters")
    opts = pipeline.RunOptions(k_grid=(6, 7, 8), restarts=1, kmeans_iter=3)
    below = checkpoint_root(spark)
    before = files_below(below)
    pipeline.run(spark, weather, trips, *dirs, "bike", "lr", "training", opts)
    out = pipeline.run(spark, weather, trips, *dirs, "bike", "lr", "test", opts)
    new = files_below(below) - before
    mine = tuple(d.removeprefix("file:") for d in (*dirs, out["path"]))
    assert new and all(f.startswith(mine) for f in new)
    assert spark.read.parquet(out["path"]).count() > 0
