"""Searches that begin again, trainings that fail, days that are scored again."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwise.checks import ml
from tripwise.operators import clustering, histogram_trees as ht, lloyd, models
from tripwise.plans import bundle, pipeline
from tripwise.plans.features import BIKE_FEATURES
from tripwise.session import scratch_path
from tripwise.sources import standins as sv, writers
from tripwise.sources.ledger import Ledger, fingerprint, key_of

CELLS = {"dt": [dict(max_depth=d, max_bins=b) for d in (2, 4) for b in (8, 16, 32)],
         "rf": [dict(num_trees=n, max_depth=d, max_bins=b) for n in (1, 2, 3) for d in (2, 3) for b in (8, 16, 32)]}


class Lost(Exception):
    """The driver goes."""


def rows_of(results):
    return [tuple(r) for r in results.orderBy("cell").collect()]


def test_entries_are_kept_and_replaced(spark):
    path = scratch_path(spark, "ledger")
    a = Ledger(spark, path)
    assert a.get("x") is None
    a.put("x", [1, 0.1 + 0.2, None])
    a.put("y", {"a": float("nan")})
    a.put("x", "new")
    b = Ledger(spark, path)
    assert b.get("x") == "new" and b.get("y")["a"] != b.get("y")["a"]
    b.put("x", "newer")
    assert Ledger(spark, path).get("x") == "newer"
    assert key_of(a=1, b=2) == key_of(b=2, a=1) != key_of(a=2, b=1)


def test_fingerprints_know_rows_and_copies_not_their_order(spark):
    df = spark.createDataFrame([(i, i * 0.5) for i in range(50)], "a int, b double")
    again = df.repartition(7).orderBy(F.desc("a"))
    assert fingerprint(df) == fingerprint(again)
    others = [df.where("a > 0"), df.union(df.limit(1)), df.union(df), df.withColumn("b", F.col("b") + (F.col("a") == 3).cast("int")),
              df.limit(0), df.withColumnRenamed("b", "c")]
    assert len({fingerprint(o) for o in [df, *others]}) == 1 + len(others)


@pytest.mark.parametrize("algo", ["dt", "rf"])
def test_a_killed_search_ends_with_the_same_table(spark, monkeypatch, algo):
    both = ml._flagged(spark, SF_SMALL)
    search = lambda journal, data=both, cells=CELLS[algo]: models.grid_search(
        spark, algo, data, None, BIKE_FEATURES, "dur", cells, 3, 1, journal)
    want_model, want, want_cell = search(None)
    path, fits, real = scratch_path(spark, "journal"), [], ht.fit

    def fit(*args):
        if len(fits) == 2:
            raise Lost
        fits.append(args)
        return real(*args)
    monkeypatch.setattr(ht, "fit", fit)
    with pytest.raises(Lost):
        search(Ledger(spark, path))
    fits[:] = fits[:1]  # one more fit may run, not two
    # The rows come back in other partitions: their draws must be those of the first run.
    model, got, cell = search(Ledger(spark, path), both.repartition(5))
    assert len(fits) == 2 and cell == want_cell
    again = rows_of(got)
    for a, b in zip(rows_of(want), again, strict=True):
        assert a[:7] == b[:7]
        if algo == "dt":
            assert a[7:] == pytest.approx(b[7:], rel=1e-9)
    assert rows_of(search(Ledger(spark, path))[1]) == again  # all from the journal: no further fit
    if algo == "dt":
        assert [tuple(t.value) for t in model.trees] == [pytest.approx(tuple(t.value), rel=1e-9) for t in want_model.trees]


def test_the_journal_tells_data_and_parameters_apart(spark, monkeypatch):
    both = ml._flagged(spark, SF_SMALL)
    path, fits, real = scratch_path(spark, "journal"), [], ht.fit
    monkeypatch.setattr(ht, "fit", lambda *args: fits.append(1) or real(*args))
    cells = [dict(num_trees=2, max_depth=2, max_bins=8)]
    run = lambda data, cells, seed: models.grid_search(spark, "rf", data, None, BIKE_FEATURES, "dur", cells, seed, 1, Ledger(spark, path))
    run(both, cells, 1)
    run(both, cells, 1)
    assert len(fits) == 1
    run(both, cells, 2)
    run(both, [dict(num_trees=2, max_depth=3, max_bins=8)], 1)
    run(both.withColumn("dur", F.col("dur") + 1), cells, 1)
    assert len(fits) == 4


def test_k_means_goes_on_from_its_last_pass(spark, monkeypatch):
    points = sv.trips(sv.table(spark, SF_SMALL, "events"))
    search = lambda journal: clustering.select_k(spark, points, (6, 7, 8), 2, 12, 5, journal=journal)
    want, elbow, _ = search(None)
    path, passes, real = scratch_path(spark, "journal"), [], lloyd.cluster_sums

    def sums(*args):
        if len(passes) == 3:
            raise Lost
        passes.append(1)
        return real(*args)
    monkeypatch.setattr(lloyd, "cluster_sums", sums)
    with pytest.raises(Lost):
        search(Ledger(spark, path))
    passes[:] = []
    monkeypatch.setattr(lloyd, "cluster_sums", lambda *args: passes.append(1) or real(*args))
    whole, counts = Ledger(spark, path), []
    got, again, _ = search(whole)
    assert sum(map(tuple, got.centres), ()) == pytest.approx(sum(want.centres, ()), rel=1e-12)
    assert [r.is_best for r in elbow.orderBy("k").collect()] == [r.is_best for r in again.orderBy("k").collect()]
    rest = len(passes)
    search(Ledger(spark, path))
    assert 0 < rest <= 9 and len(passes) == rest


def _files(spark, labelled=True):
    return ml._trip_files(spark, SF_SMALL, "bike", labelled)


OPTS = dict(k_grid=(6, 7, 8), restarts=1, kmeans_iter=4)


def test_a_training_that_fails_leaves_the_earlier_one_whole(spark, monkeypatch):
    weather, trips = _files(spark)
    model, km = scratch_path(spark, "m"), scratch_path(spark, "k")
    with pytest.raises(FileNotFoundError, match="no training"):
        pipeline.run(spark, weather, trips, model, km, "bike", "lr", "test")
    first = pipeline.run(spark, weather, trips, model, km, "bike", "lr", "training", pipeline.RunOptions(**OPTS))
    before = pipeline.run(spark, weather, trips, model, km, "bike", "lr", "test")
    real, saved = models.save_model, []

    def save(spark, model, path):
        if len(saved) == 1:
            raise Lost  # new clusters are written, the new model is not
        saved.append(path)
        return real(spark, model, path)
    monkeypatch.setattr(models, "save_model", save)
    with pytest.raises(Lost):
        pipeline.run(spark, weather, trips, model, km, "bike", "lr", "training", pipeline.RunOptions(**OPTS, seed=8))
    after = pipeline.run(spark, weather, trips, model, km, "bike", "lr", "test")
    assert after["version"] == before["version"] == first["version"]
    assert (after["mse_all"], after["mse_held_out"]) == pytest.approx((before["mse_all"], before["mse_held_out"]), rel=1e-12)
    monkeypatch.setattr(models, "save_model", real)
    second = pipeline.run(spark, weather, trips, model, km, "bike", "lr", "training", pipeline.RunOptions(**OPTS, seed=8))
    now = bundle.current(spark, model, km, "lr")
    assert now.version == second["version"] != first["version"] and now.split["seed"] == 8
    with pytest.raises(ValueError, match="'lr'"):
        bundle.current(spark, model, km, "dt")


def test_a_resumed_training_publishes_the_same_model(spark, monkeypatch):
    weather, trips = _files(spark)
    journal, real, fits = scratch_path(spark, "journal"), ht.fit, []
    opts = pipeline.RunOptions(**OPTS, cells=CELLS["dt"], parallelism=1, journal_dir=journal)
    dirs = lambda: (scratch_path(spark, "m"), scratch_path(spark, "k"))
    whole = pipeline.run(spark, weather, trips, *dirs(), "bike", "dt", "training", pipeline.RunOptions(**OPTS, cells=CELLS["dt"]))

    def fit(*args):
        fits.append(1)
        if len(fits) == 2:
            raise Lost
        return real(*args)
    monkeypatch.setattr(ht, "fit", fit)
    model, km = dirs()
    with pytest.raises(Lost):
        pipeline.run(spark, weather, trips, model, km, "bike", "dt", "training", opts)
    got = pipeline.run(spark, weather, trips, model, km, "bike", "dt", "training", opts)
    assert len(fits) == 4 and got["best_cell"] == whole["best_cell"]
    for a, b in zip(whole["results"], got["results"], strict=True):
        assert tuple(a)[7:] == pytest.approx(tuple(b)[7:], rel=1e-9)
    assert bundle.current(spark, model, km, "dt").version == got["version"]


def _listing(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_scoring_a_day_again_leaves_the_other_days_files(spark, fmt):
    dirs = ml._published(spark, "bike", "lr")
    weather, trips = _files(spark, False)
    opts = pipeline.RunOptions(output_format=fmt)
    out = pipeline.run(spark, weather, trips, *dirs, "bike", "lr", "prediction", opts)
    path = out["path"].removeprefix("file:")
    before = _listing(path)
    days = {f.split("/")[0] for f in before}
    assert len(days) > 5 and len(before) <= 2 * len(days)  # not tasks times days
    _, one = ml._trip_files(spark, SF_SMALL, "bike", False, "dt = date'2024-01-05'")
    opts.replace = "days"
    pipeline.run(spark, weather, one, *dirs, "bike", "lr", "prediction", opts)
    after = _listing(path)
    assert {f: t for f, t in after.items() if "01-05" not in f} == {f: t for f, t in before.items() if "01-05" not in f}
    assert {f for f in after if "01-05" in f}.isdisjoint(f for f in before if "01-05" in f)
    if fmt == "parquet":
        day = spark.read.schema(out["schema"]).parquet(path).where("dt = date'2024-01-05'")
        assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().toString()
        assert day.count() > 0
    with pytest.raises(ValueError, match="replace"):
        writers.write_scored(spark.range(1), path, replace="some")


def test_no_trips_give_no_rows(spark):
    dirs = ml._published(spark, "bike", "lr")
    weather, none = ml._trip_files(spark, SF_SMALL, "bike", False, "false")
    out = pipeline.run(spark, weather, none, *dirs, "BIKE", "Lr", "PREDICTION")
    assert spark.read.schema(out["schema"]).parquet(out["path"]).count() == 0
