"""Operator semantics against brute-force Python on small inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwise.operators import clustering, cleaning, linear, outliers, splits
from tripwise.sources import standins as sv


def elbow_brute(costs):
    """The sequential rule: second difference, strict '>', first maximum wins."""
    best, one, two, best_asd = min(costs), math.inf, math.inf, -math.inf
    for k in sorted(costs):
        j = costs[k]
        if two != math.inf:
            asd = two + j - 2 * one
            if asd > best_asd:
                best_asd, best = asd, k - 1
        two, one = one, j
    return best


@pytest.mark.parametrize("seed", range(6))
def test_elbow_matches_sequential_rule(spark, seed):
    rnd = random.Random(seed)
    ks = list(range(6, 13))
    costs = {k: float(rnd.choice([rnd.uniform(0, 100), 50.0, 10.0])) for k in ks}
    if seed == 5:
        costs = {k: 1.0 for k in ks}  # all ties: the first candidate wins
    rows = [(k, 0, c) for k, c in costs.items()]
    df = spark.createDataFrame(rows, "k int, restart int, cost double")
    got = [r["k"] for r in clustering.elbow_table(df).where("is_best").collect()]
    assert got == [elbow_brute(costs)]


def test_nearest_centre_brute_force(spark):
    t = sv.trips(sv.table(spark, SF_SMALL, "events"))
    cs = sv.fixed_centres(8)
    got = {r["trip_id"]: (r["km1"], r["km2"]) for r in clustering.assign_clusters(t, cs).collect()}
    for r in t.collect():
        def near(lat, lon):
            d = [((lat - a) ** 2 + (lon - b) ** 2, i) for i, (a, b) in enumerate(cs)]
            return float(min(d)[1])
        assert got[r["trip_id"]] == (near(r["lat1"], r["lon1"]), near(r["lat2"], r["lon2"]))


def test_gradient_descent_matches_per_row_descent(spark):
    t = sv.trips(sv.table(spark, SF_SMALL, "events")).where("dur between 120 and 3600")
    feats = ["lat1", "lon1", "psg"]
    rows = t.select(*feats, "dur").collect()
    x = np.array([[r[f] for f in feats] for r in rows])
    y = np.array([r["dur"] for r in rows])
    step, iters = 1e-5, 40
    w, prev = np.zeros(3), None
    for i in range(1, iters + 1):
        w = w - step / math.sqrt(i) * ((x @ w - y) @ x) / len(y)
        if prev is not None and np.linalg.norm(w - prev) < 1e-3 * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    m = linear.moments(t, feats, "dur")
    got, _ = linear.descend(m, step, [iters])[iters]
    assert np.allclose(got, w, rtol=1e-9, atol=1e-12)
    assert math.isclose(m.mse(got), float(np.mean((x @ got - y) ** 2)), rel_tol=1e-9)


def test_speed_filter_brute_force(spark):
    t = sv.trips(sv.table(spark, SF_SMALL, "events")).withColumn("dist", F.col("lat1") * 1000 + F.col("lon2"))
    rows = t.select("trip_id", "dist", "dur").where("dur > 0").collect()
    s = [r["dist"] / r["dur"] for r in rows]
    m = sum(s) / len(s)
    sd = math.sqrt(sum((v - m) ** 2 for v in s) / len(s))
    want = {r["trip_id"] for r, v in zip(rows, s) if m - 3 * sd < v < m + 3 * sd}
    got = {r["trip_id"] for r in outliers.speed_3sigma(t.where("dur > 0")).collect()}
    assert got == want


def test_split_line_drops_trailing_empty_fields(spark):
    df = spark.createDataFrame([("a,b,,",), (",a,,b",), ("a",)], "line string")
    got = [r[0] for r in df.select(cleaning.split_line(F.col("line"))).collect()]
    java_like = [s.split(",") for s in ("a,b,,", ",a,,b", "a")]
    java_like = [p[:max([i + 1 for i, v in enumerate(p) if v] or [0])] for p in java_like]
    assert got == java_like


def test_hash_split_is_stable_and_proportional(spark):
    t = sv.trips(sv.table(spark, SF_SMALL, "events"))
    a, _ = splits.split_hash(t, "trip_id", 0.7, 3)
    b, _ = splits.split_hash(t.repartition(5), "trip_id", 0.7, 3)
    ids_a = {r[0] for r in a.select("trip_id").collect()}
    assert ids_a == {r[0] for r in b.select("trip_id").collect()}
    assert 0.6 < len(ids_a) / t.count() < 0.8


def test_peak_window_edges(spark):
    from tripwise.functions import day_fraction_of_time, peak_flag, weekday_flag
    rows = [("2024-01-01", "06:00:00", 1.0), ("2024-01-01", "10:00:00", 1.0), ("2024-01-01", "10:00:01", 0.0),
            ("2024-01-01", "05:59:59", 0.0), ("2024-01-01", "20:00:00", 1.0), ("2024-01-06", "08:00:00", 0.0)]
    df = spark.createDataFrame(rows, "d string, t string, want double").withColumn("d", F.to_date("d"))
    got = df.select(peak_flag(F.col("d"), day_fraction_of_time(F.col("t"))).alias("p"), "want").collect()
    assert all(r["p"] == r["want"] for r in got)
    wk = df.select(weekday_flag(F.col("d")).alias("w")).collect()
    assert [r["w"] for r in wk] == [1.0] * 5 + [0.0]


def test_grid_keeps_the_argmin_model(spark):
    from tripwise.checks import ml
    from tripwise.operators import models
    from tripwise.plans.features import BIKE_FEATURES
    train, test = ml._split(spark, SF_SMALL)
    cells = [dict(max_depth=d, max_bins=16) for d in (1, 3, 6)]
    best, res, cell = models.grid_search(spark, "dt", train, test, BIKE_FEATURES, "dur", cells, 1, parallelism=3)
    rows = sorted(res.collect(), key=lambda r: (r["test_mse"], r["cell"]))
    assert cell == cells[rows[0]["cell"]]
    assert best.depth == cell["max_depth"]


def test_grid_lr_snapshots_equal_separate_fits(spark):
    from tripwise.checks import ml
    from tripwise.plans.features import BIKE_FEATURES
    train, _ = ml._split(spark, SF_SMALL)
    m = linear.moments(train, BIKE_FEATURES, "dur")
    path = linear.descend(m, 1e-9, [25, 50, 100])
    for n in (25, 50, 100):
        alone, _ = linear.descend(m, 1e-9, [n])[n]
        assert np.array_equal(alone, path[n][0])


@pytest.mark.parametrize("n_features", [3, 19])
def test_moments_both_paths_agree_with_numpy(spark, n_features):
    t = sv.trips(sv.table(spark, SF_SMALL, "events"))
    cols = ["lat1", "lon1", "psg", "id1", "id2", "yr", "gdr", "lat2", "lon2"]
    exprs = [F.col(cols[i % len(cols)]) * F.lit(1.0 + i) for i in range(n_features)]
    df = t.select(*[e.alias(f"x{i}") for i, e in enumerate(exprs)], "dur")
    feats = [f"x{i}" for i in range(n_features)]
    rows = df.collect()
    x = np.array([[r[f] for f in feats] for r in rows])
    y = np.array([r["dur"] for r in rows])
    m = linear.moments(df, feats, "dur")
    assert m.n == len(y)
    assert np.allclose(m.gram, x.T @ x, rtol=1e-12)
    assert np.allclose(m.xty, x.T @ y, rtol=1e-12)


def test_calendar_and_distance_against_python(spark):
    import datetime as dtm
    rnd = random.Random(11)
    rows = []
    for _ in range(300):
        d = dtm.date(2015, 1, 1) + dtm.timedelta(days=rnd.randrange(0, 3 * 366))
        h, mi, s = rnd.randrange(24), rnd.randrange(60), rnd.randrange(60)
        la1, lo1, la2, lo2 = (rnd.uniform(40.4, 41.0), rnd.uniform(-74.3, -73.6),
                              rnd.uniform(40.4, 41.0), rnd.uniform(-74.3, -73.6))
        rows.append((d, f"{h:02d}:{mi:02d}:{s:02d}", la1, lo1, la2, lo2))
    df = spark.createDataFrame(rows, "d date, t string, la1 double, lo1 double, la2 double, lo2 double")
    from tripwise.functions import (chord_distance, day_fraction_of_time, day_of_year_fraction, peak_flag,
                                    weekday_flag)
    frac = day_fraction_of_time(F.col("t"))
    got = df.select("d", "t", "la1", "lo1", "la2", "lo2",
                    day_of_year_fraction(F.col("d")).alias("days"), frac.alias("tm"),
                    weekday_flag(F.col("d")).alias("wk"), peak_flag(F.col("d"), frac).alias("pk"),
                    chord_distance(F.col("la1"), F.col("lo1"), F.col("la2"), F.col("lo2")).alias("dist")).collect()
    for r in got:
        d = r["d"]
        last = dtm.date(d.year, 12, 31).timetuple().tm_yday
        assert r["days"] == d.timetuple().tm_yday / last
        h, mi, s = (float(p) for p in r["t"].split(":"))
        tm = (s + mi * 60 + h * 3600) / 86400
        assert r["tm"] == tm
        wk = 1.0 if d.weekday() < 5 else 0.0
        assert r["wk"] == wk
        peak = wk == 1.0 and (0.25 <= tm <= 36000 / 86400 or 57600 / 86400 <= tm <= 72000 / 86400)
        assert r["pk"] == (1.0 if peak else 0.0)

        def xyz(la, lo):
            a, b = math.radians(la), math.radians(lo)
            return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)
        p, q = xyz(r["la1"], r["lo1"]), xyz(r["la2"], r["lo2"])
        want = math.sqrt(sum((u - v) ** 2 for u, v in zip(p, q))) * 6371000
        assert math.isclose(r["dist"], want, rel_tol=1e-9, abs_tol=1e-6)


def test_weighted_kmeans_cost_equals_cost_on_all_points(spark):
    """Distinct points with counts as weights: the fit's cost is the cost over every trip."""
    t = sv.trips(sv.table(spark, SF_SMALL, "events")).select(
        F.round("lat2", 2).alias("lat2"), F.round("lon2", 2).alias("lon2"))   # many repeated points
    m = clustering.fit_kmeans(t, 6, 3, weighted=True)
    full = clustering.kmeans_cost(t, clustering.centres_of(m)).first()["cost"]
    distinct = clustering.cost_table(clustering.kmeans_points(t, weighted=True), {6: clustering.centres_of(m)}, "lat", "lon")
    assert math.isclose(distinct.first()["cost"], full, rel_tol=1e-9)
    assert clustering.kmeans_points(t, weighted=True).count() < t.count()


def plain_lloyd(points, centres, max_iter, tol=1e-4):
    for _ in range(max_iter):
        sums = [[0, 0.0, 0.0] for _ in centres]
        for a, b in points:
            d = [(a - x) ** 2 + (b - y) ** 2 for x, y in centres]
            s = sums[d.index(min(d))]
            s[0], s[1], s[2] = s[0] + 1, s[1] + a, s[2] + b
        new = [(s[1] / s[0], s[2] / s[0]) if s[0] else c for s, c in zip(sums, centres)]
        far = max((x - u) ** 2 + (y - v) ** 2 for (x, y), (u, v) in zip(new, centres))
        centres = new
        if far <= tol * tol:
            break
    return centres


@pytest.mark.parametrize("weighted", [False, True])
def test_all_cells_of_one_loop_equal_plain_fits(spark, weighted):
    import hashlib
    t = sv.trips(sv.table(spark, SF_SMALL, "events")).where("trip_id % 3 = 0").select(
        F.round("lat2", 2).alias("lat2"), F.round("lon2", 2).alias("lon2"))
    rows = [tuple(r) for r in t.collect()]
    model, _, costs = clustering.select_k(spark, t, (2, 3, 5), restarts=2, max_iter=12, seed=4, weighted=weighted)
    got = {(c["k"], c["restart"]): c["cost"] for c in costs.collect()}
    for k, r in got:
        def digest(p):
            unit = [str(math.floor(x * 1e6 + 0.5)) for x in p]
            return hashlib.md5(",".join([*unit, str(4 + r)]).encode()).hexdigest()
        want = plain_lloyd(rows, sorted(set(rows), key=lambda p: (digest(p), p))[:k], 12)
        cost = sum(min((a - x) ** 2 + (b - y) ** 2 for x, y in want) for a, b in rows)
        assert math.isclose(got[k, r], cost, rel_tol=1e-9)


def test_seeds_of_few_or_equal_points(spark):
    from tripwise.operators import lloyd
    pts = clustering.kmeans_points(spark.createDataFrame([(40.5, -74.0)] * 500 + [(40.6, -74.1)], "lat2 double, lon2 double"))
    fits = lloyd.fit(pts, [(6, 0), (1, 1)], 3, 5)
    assert sorted(map(tuple, fits[6, 0].tolist())) == [(40.5, -74.0), (40.6, -74.1)] and len(fits[1, 1]) == 1
    assert len(lloyd.fit(pts.limit(0), [(6, 0)], 3, 5)[6, 0]) == 0


def test_shared_depth_tree_grid_equals_direct_fits(spark):
    from tripwise.checks import ml
    from tripwise.operators import models
    from tripwise.plans.features import BIKE_FEATURES
    train, test = ml._split(spark, SF_SMALL)
    cells = [dict(max_depth=d, max_bins=b) for d in (2, 4, 7) for b in (8, 32)]
    best, shared, chosen = models.grid_search(spark, "dt", train, test, BIKE_FEATURES, "dur", cells, 5)
    one, again, _ = models.grid_search(spark, "dt", ml._flagged(spark, SF_SMALL), None, BIKE_FEATURES, "dur", cells, 5)
    for got, frame in ((shared, train), (again, train)):
        for r in got.collect():
            direct = models.fit_tree(frame, BIKE_FEATURES, "dur", r["max_depth"], r["max_bins"], 5)
            for df, mse in ((train, r["train_mse"]), (test, r["test_mse"])):
                e = direct.transform(df).agg(F.avg(F.pow(F.col("dur") - F.col("prediction"), 2))).first()[0]
                assert math.isclose(e, mse, rel_tol=1e-9)
    direct = models.fit_tree(train, BIKE_FEATURES, "dur", chosen["max_depth"], chosen["max_bins"], 5)
    assert best.toDebugString == one.toDebugString == direct.toDebugString


def test_weather_join_is_a_shuffle_join_past_the_planners_bound(spark):
    import io
    import contextlib
    from tripwise.operators import joins
    ev = sv.table(spark, SF_SMALL, "events")
    t, w = sv.trips(ev), sv.weather(ev)
    small = joins.join_weather(t, w)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # no automatic broadcast either
    try:
        big = joins.join_weather(t, w)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            big.explain()
        assert "BroadcastHashJoin" not in buf.getvalue()
        assert small.select("trip_id").exceptAll(big.select("trip_id")).count() == 0
        assert small.count() == big.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rows_with_unparseable_values_are_rejected_before_models(spark):
    from tripwise.plans.features import BIKE_FEATURES, build_features
    ev = sv.table(spark, SF_SMALL, "events")
    t = sv.bike_trips(ev, False).withColumn(
        "time", F.when(F.col("trip_id") % 2 == 0, F.lit("xx:yy")).otherwise(F.col("time")))
    f = build_features(t, sv.weather(ev), sv.fixed_centres(8), "bike", labelled=False)
    assert f.where(F.col("tm").isNull()).count() == 0
    assert f.where(F.col("trip_id") % 2 == 0).count() == 0
    from tripwise.operators import linear, scoring
    m = linear.LinearModel(BIKE_FEATURES, [0.0] * len(BIKE_FEATURES))
    assert scoring.score_unlabelled(m, f, BIKE_FEATURES).count() == f.count() > 0


def test_seeded_fits_are_deterministic(spark):
    from tripwise.checks import ml
    from tripwise.operators import models
    from tripwise.plans.features import BIKE_FEATURES
    t = sv.trips(sv.table(spark, SF_SMALL, "events"))
    a = clustering.centres_of(clustering.fit_kmeans(t, 6, 11, max_iter=20))
    b = clustering.centres_of(clustering.fit_kmeans(t, 6, 11, max_iter=20))
    assert a == b
    train, _ = ml._split(spark, SF_SMALL)
    d1 = models.fit_tree(train, BIKE_FEATURES, "dur", 5, 32, 4).toDebugString
    d2 = models.fit_tree(train, BIKE_FEATURES, "dur", 5, 32, 4).toDebugString
    assert d1.split("\n", 1)[1] == d2.split("\n", 1)[1]
    f1 = models.fit_forest(train, BIKE_FEATURES, "dur", 4, 4, 32, 4).toDebugString
    f2 = models.fit_forest(train, BIKE_FEATURES, "dur", 4, 4, 32, 4).toDebugString
    assert f1.split("\n", 1)[1] == f2.split("\n", 1)[1]
    r1 = {r[0] for r in splits.split_random(t, 9)[0].select("trip_id").collect()}
    r2 = {r[0] for r in splits.split_random(t, 9)[0].select("trip_id").collect()}
    assert r1 == r2


def test_k_selection_scores_the_final_centres(spark):
    t = sv.trips(sv.table(spark, SF_SMALL, "events"))
    model, elbow, costs = clustering.select_k(spark, t, (6, 7, 8), restarts=2, max_iter=3, seed=5)
    again = {(k, r): clustering.fit_kmeans(t, k, 5 + r, 3) for k in (6, 7, 8) for r in range(2)}
    for c in costs.collect():
        want = clustering.kmeans_cost(t, clustering.centres_of(again[c["k"], c["restart"]])).first()["cost"]
        assert math.isclose(c["cost"], want, rel_tol=1e-9)


def test_null_fields_keep_their_place(spark):
    from tripwise.session import scratch_path
    from tripwise.sources import readers, writers
    path = writers.write_lines(spark.createDataFrame([("a", None, "c")], "x string, y string, z string"), scratch_path(spark, "n"))
    assert [r.line for r in readers.read_lines(spark, path).collect()] == ["a,,c"]


def test_unparseable_timestamps_are_rejected_not_raised(spark):
    from tripwise.operators import cleaning as cl
    raw = sv.raw_yellow(sv.table(spark, SF_SMALL, "events"))
    bad = raw.withColumn("tpep_pickup_datetime", F.when(F.col("event_id") % 2 == 0, "not a time").otherwise(F.col("tpep_pickup_datetime")))
    assert bad.where(cl.trip_duration().isNull()).count() == bad.where("event_id % 2 = 0").count() > 0
    want = cl.clean_taxi(raw, keep=("event_id",)).where("event_id % 2 <> 0")
    assert cl.clean_taxi(bad, keep=("event_id",)).exceptAll(want).count() == 0 and want.count() > 0
