"""Train, test and predict end to end on files written from the stand-ins."""

import os

import pytest

from conftest import SF_SMALL
from tripwise.plans import pipeline
from tripwise.session import scratch_path
from tripwise.sources import readers, standins as sv, writers

LAB = {"taxi": ["dt", "time", "dur", "lat1", "lon1", "lat2", "lon2", "psg"],
       "bike": ["dt", "time", "dur", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"]}


@pytest.mark.parametrize("dataset,algo", [("bike", "dt"), ("taxi", "lr"), ("bike", "rf")])
def test_train_test_predict(spark, dataset, algo):
    ev = sv.table(spark, SF_SMALL, "events")
    weather = writers.write_csv(sv.weather(ev), scratch_path(spark, "w"), header=True)
    trips = writers.write_csv(sv.trips(ev).select(*LAB[dataset]), scratch_path(spark, "t"))
    unl = writers.write_csv(sv.trips(ev).select(*[c for c in LAB[dataset] if c != "dur"]), scratch_path(spark, "u"))
    model_dir, km_dir = scratch_path(spark, "model"), scratch_path(spark, "km")
    cells = {"dt": [dict(max_depth=3, max_bins=16), dict(max_depth=5, max_bins=32)],
             "rf": [dict(num_trees=4, max_depth=4, max_bins=32)],
             "lr": None}[algo]
    opts = pipeline.RunOptions(cells=cells, k_grid=(6, 7, 8), restarts=1, kmeans_iter=10)
    tr = pipeline.run(spark, weather, trips, model_dir, km_dir, dataset, algo, "Training", opts)
    assert tr["rejects"] == {"trips": {"accepted": ev.count()}, "weather": {"accepted": sv.weather(ev).count(), "header": 1}}
    assert tr["k"] in (6, 7, 8) and tr["best_cell"] is not None
    te = pipeline.run(spark, weather, trips, model_dir, km_dir, dataset, algo, "test", opts)
    scored = spark.read.parquet(te["path"])
    feats = readers.read_trips(spark, trips, dataset)
    assert 0 < scored.count() <= feats.count()
    var = scored.selectExpr("var_pop(dur) v").first()["v"]
    assert te["mse_all"] < 4 * var
    pr = pipeline.run(spark, weather, unl, model_dir, km_dir, dataset, algo, "prediction", opts)
    out = spark.read.parquet(pr["path"])
    assert "prediction" in out.columns and "dur" not in out.columns and out.count() > 0


def test_bad_arguments_rejected(spark):
    with pytest.raises(ValueError):
        pipeline.run(spark, "w", "t", "m", "k", "bus", "dt", "training")


def test_trip_ids_do_not_depend_on_file_splitting(spark):
    ev = sv.table(spark, SF_SMALL, "events")
    one = writers.write_csv(sv.trips(ev).select(*LAB["bike"]).coalesce(1), scratch_path(spark, "one"))
    many = writers.write_csv(sv.trips(ev).select(*LAB["bike"]).repartition(7), scratch_path(spark, "many"))
    a = readers.read_trips(spark, one, "bike").select("trip_id", "dt", "time", "lat1")
    b = readers.read_trips(spark, many, "bike").select("trip_id", "dt", "time", "lat1")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_cleaned_taxi_files_feed_the_pipeline(spark):
    """Cleaning job output (9 columns, with trip_distance) is a valid training input."""
    from tripwise.plans.cleaning_jobs import clean_taxi_job
    ev = sv.table(spark, SF_SMALL, "events")
    src = writers.write_csv(sv.yellow_file(ev), scratch_path(spark, "y"), header=True)
    out = clean_taxi_job(spark, f"{src}/*.csv", scratch_path(spark, "yc"))
    assert out["in_box"] > 0
    weather = writers.write_csv(sv.weather(ev), scratch_path(spark, "w"), header=True)
    opts = pipeline.RunOptions(k_grid=(6, 7, 8), restarts=1, kmeans_iter=10)
    res = pipeline.run(spark, weather, out["path"], scratch_path(spark, "m"), scratch_path(spark, "k"),
                       "taxi", "lr", "training", opts)
    assert res["best_cell"] is not None


def test_job_counts_equal_one_pass_counts(spark):
    from tripwise.operators import cleaning as cl
    from tripwise.plans.cleaning_jobs import clean_bike_job, clean_taxi_job
    ev = sv.table(spark, SF_SMALL, "events")
    src = writers.write_csv(sv.yellow_file(ev), scratch_path(spark, "yy"), header=True)
    out = clean_taxi_job(spark, f"{src}/*.csv", scratch_path(spark, "yyc"))
    read = readers.read_taxi_csv(spark, f"{src}/*.csv", cl.YELLOW)
    want = cl.cleaning_counts(read.where(~read.malformed)).first().asDict()
    want |= dict(rows=ev.count(), malformed=ev.where("event_id % 31 = 0").count())
    assert {k: out[k] for k in want} == want
    assert spark.read.csv(out["path"]).count() == want["in_box"]
    d = scratch_path(spark, "bb")
    sv.raw_bike(ev).select("line").write.text(d)
    res = clean_bike_job(spark, {"2015": d, "2016": d}, scratch_path(spark, "bbc"))
    raw = readers.read_lines(spark, d)
    assert res["counts"] == {"2015": cl.clean_bike(raw, cl.BIKE_2015).count(),
                             "2016": cl.clean_bike(raw, cl.BIKE_2016).count()}


def test_partitioned_scored_output_round_trips(spark):
    from pyspark.sql import functions as F
    ev = sv.table(spark, SF_SMALL, "events")
    df = sv.trips(ev).select("trip_id", "dt", "dur")
    path = writers.write_scored(df, scratch_path(spark, "part"), partition_by=["dt"])
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    one_day = back.where(F.col("dt") == F.lit("2024-01-05").cast("date"))
    assert one_day.count() == df.where(F.col("dt") == F.lit("2024-01-05").cast("date")).count() > 0


def test_taxi_files_are_read_by_name_whatever_their_headers(spark):
    from tripwise.operators import cleaning as cl
    ev = sv.table(spark, SF_SMALL, "events")
    wide = sv.yellow_file(ev)
    one = writers.write_csv(wide, scratch_path(spark, "one"), header=True)
    two = writers.write_csv(wide.select(*reversed(wide.columns)), scratch_path(spark, "two"), header=True)
    a, b = (readers.read_taxi_csv(spark, p, cl.YELLOW) for p in (one, two))
    assert a.count() == ev.count() and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert a.select("trip_distance").count() == a.where("malformed or not malformed").count()
    three = writers.write_csv(wide.select("VendorID"), scratch_path(spark, "three"), header=True)
    both = readers.read_taxi_csv(spark, [one, two, three], cl.YELLOW)
    assert both.exceptAll(a.unionByName(b)).count() == 0 and both.count() == 2 * ev.count()
    assert {(r.files, r.used) for r in readers.layouts(spark, [one, two, three], cl.YELLOW).collect()} >= {(1, True), (1, False)}
    with pytest.raises(ValueError, match="lpep_pickup_datetime"):
        readers.read_taxi_csv(spark, one, cl.GREEN)


def test_rejected_lines_go_to_a_side_output_with_their_reasons(spark):
    ev = sv.table(spark, SF_SMALL, "events")
    path = scratch_path(spark, "mixed")
    good = sv.trips(ev).select(*LAB["bike"]).limit(20)
    writers.write_csv(good, path)
    spark.createDataFrame([("2024-01-05,08:00:00,oops,1,40.7,-74,2,40.7,-74,1980,1",), ("no date,08:00:00,300,1,40.7,-74,2,40.7,-74,1980,1",),
                           ("",), ("2024-01-05,08:00:00",)], "value string").write.mode("append").text(path)
    side = scratch_path(spark, "side")
    opts = pipeline.RunOptions(rejects_dir=side)
    t, counts = pipeline._trips(spark, path, "bike", True, opts)
    assert t.count() == 20 and counts["trips"] == {"accepted": 20, "dur": 2, "dt": 1}
    kept = spark.read.parquet(side).collect()
    assert sorted(r.reject for r in kept) == ["dt", "dur", "dur"] and any("no date" in r.raw for r in kept)


def test_eight_and_nine_column_trip_files_give_the_same_rows(spark):
    ev = sv.table(spark, SF_SMALL, "events")
    path = writers.write_csv(sv.trips(ev).select(*LAB["taxi"]), scratch_path(spark, "eight"))
    t = readers.read_trips(spark, path, "taxi")
    assert t.count() == len(t.collect()) == ev.count()
    r = readers.trip_rejects(spark, path, "taxi").first()
    assert (r.lines, r.headers, r.rejected) == (ev.count(), 0, 0)


@pytest.mark.parametrize("split", ["hash", "random"])
def test_held_out_mse_of_test_mode_is_that_of_training(spark, split):
    import math
    ev = sv.table(spark, SF_SMALL, "events")
    weather = writers.write_csv(sv.weather(ev), scratch_path(spark, "w"), header=True)
    trips = writers.write_csv(sv.trips(ev).select(*LAB["bike"]), scratch_path(spark, "t"))
    model, km = scratch_path(spark, "m"), scratch_path(spark, "k")
    opts = pipeline.RunOptions(cells=[dict(max_depth=3, max_bins=16)], k_grid=(6, 7, 8), restarts=1, kmeans_iter=5, seed=9, split=split)
    tr = pipeline.run(spark, weather, trips, model, km, "bike", "dt", "training", opts)
    te = pipeline.run(spark, weather, trips, model, km, "bike", "dt", "test")  # the split comes with the model
    if split == "random":
        assert te["mse_held_out"] is None
    else:
        assert math.isclose(te["mse_held_out"], tr["results"][0]["test_mse"], rel_tol=1e-9)


def test_a_given_master_survives(spark):
    from tripwise.session import get_session
    import inspect
    assert get_session().sparkContext.master == spark.sparkContext.master
    assert all(p.default in (None, "tripwise") for p in inspect.signature(get_session).parameters.values())
