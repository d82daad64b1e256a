"""Checks of splits, linear scoring, MSE, grid choice, gradient descent (exact,
with oracles) and of the fits, grids and model round trips (rows only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwise.checks.core import N_CENTRES, feature_rows_sql
from tripwise.checks.registry import events, r, register, weather_df
from tripwise.operators import clustering, linear, lloyd, models, scoring, splits
from tripwise.operators import histogram_trees as trees
from tripwise.plans.features import BIKE_FEATURES, LABEL, TAXI_FEATURES, build_features
from tripwise.session import scratch_path
from tripwise.sources import standins as sv
from tripwise.sources.standin_sql import with_views

# The published weights of the bike linear model (19 features, no intercept).
BIKE_WEIGHTS = [2.3793087275367977E-5, 8.252425280153076E-5, 0.00371373182405045, 0.0017712775824036049,
                -0.0032188557586419943, 0.008862060982318714, 0.0017710736827704567, -0.0032178271073041017,
                -5.461110376730669E-5, 1.0864753431480841E-4, 0.3035367808606727, -9.204049893379684E-5,
                -1.4284562848393268E-4, 0.08202064184937534, 2.4399763750571106E-4, 0.007276114508199349,
                1.3075895301246786E-5, -3.1588619109791697E-6, -3.055814373116672E-4]
SEED = 7


def bike_features(spark, sf_dir, labelled=True):
    ev = events(spark, sf_dir)
    return build_features(sv.bike_trips(ev, labelled), weather_df(spark, sf_dir), sv.fixed_centres(N_CENTRES),
                          "bike", labelled)


def bike_sql(body: str, labelled: bool = True, extra: dict[str, str] | None = None) -> str:
    """``body`` over the bike feature rows (view ``f``)."""
    return feature_rows_sql(BIKE_FEATURES, labelled, body, extra)


def linear_sql() -> str:
    return " + ".join(f"{w!r}*{f}" for w, f in zip(BIKE_WEIGHTS, BIKE_FEATURES))


@register("split_hash", with_views(["trips"], f"select trip_id, {splits.hash_fraction_sql('trip_id', SEED)} < 0.7 "
                                              "as in_train from trips"))
def q_split_hash(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return t.select("trip_id", (splits.hash_fraction(F.col("trip_id"), SEED) < F.lit(0.7)).alias("in_train"))


@register("score_test_linear", bike_sql(f"select trip_id, dur, round({linear_sql()}, 6) as prediction, "
                                         f"round(dur - ({linear_sql()}), 6) as residual from f"))
def q_score_test_linear(spark, sf_dir):
    m = linear.LinearModel(BIKE_FEATURES, BIKE_WEIGHTS)
    s = scoring.score_labelled(m, bike_features(spark, sf_dir), BIKE_FEATURES)
    return s.select("trip_id", "dur", r("prediction", 6).alias("prediction"), r("residual", 6).alias("residual"))


@register("score_pred_linear", bike_sql(f"select trip_id, round({linear_sql()}, 6) as prediction from f", False))
def q_score_pred_linear(spark, sf_dir):
    m = linear.LinearModel(BIKE_FEATURES, BIKE_WEIGHTS)
    s = scoring.score_unlabelled(m, bike_features(spark, sf_dir, False), BIKE_FEATURES)
    return s.select("trip_id", r("prediction", 6).alias("prediction"))


@register("mse", bike_sql(f"select round(avg(pow(dur - ({linear_sql()}), 2)), 4) as mse from f"))
def q_mse(spark, sf_dir):
    m = linear.LinearModel(BIKE_FEATURES, BIKE_WEIGHTS)
    s = scoring.score_labelled(m, bike_features(spark, sf_dir), BIKE_FEATURES)
    return scoring.mse(s).select(r("mse", 4).alias("mse"))


# Constant-speed candidate models for the grid choice: prediction = dist / speed.
GRID_SPEEDS = (2.0, 4.0, 6.0, 8.0, 10.0, 12.0)


@register("grid_argmin", bike_sql(f"""select cell, speed, round(test_mse, 4) as test_mse from (
 select g.cell, g.speed, avg(pow(dur - dist / g.speed, 2)) as test_mse
 from f, (select * from (values {', '.join(f'({i}, {v!r}e0)' for i, v in enumerate(GRID_SPEEDS))}) as v(cell, speed)) g
 where {splits.hash_fraction_sql('trip_id', SEED)} >= 0.7 group by g.cell, g.speed) q
 where test_mse is not null and not isnan(test_mse) order by test_mse, cell limit 1"""))
def q_grid_argmin(spark, sf_dir):
    """Held-out MSE of every cell in ONE pass (one average per cell), then the best cell."""
    _, test = splits.split_hash(bike_features(spark, sf_dir), "trip_id", 0.7, SEED)
    agg = test.agg(*[F.avg(F.pow(F.col("dur") - F.col("dist") / F.lit(v), 2)).alias(f"m{i}")
                     for i, v in enumerate(GRID_SPEEDS)])
    stack = "stack({}, {}) as (cell, speed, test_mse)".format(
        len(GRID_SPEEDS), ", ".join(f"{i}, {v!r}D, m{i}" for i, v in enumerate(GRID_SPEEDS)))
    res = agg.selectExpr(stack).select(F.col("cell").cast("int"), "speed", "test_mse")
    best = models.grid_argmin(res, "test_mse", "cell")
    return best.select("cell", "speed", r("test_mse", 4).alias("test_mse"))


GD_FEATURES = BIKE_FEATURES
GD_STEP = 1e-9
GD_ITERS = 3


def _gd_sql() -> str:
    """Three unrolled full-batch steps over the bike feature rows, with the
    convergence test after step 2 (which stops before step 3)."""
    x = GD_FEATURES
    n = len(x)
    ctes: dict[str, str] = {}
    prev = None
    for t in range(1, GD_ITERS + 1):
        src = "f" if prev is None else f"f, {prev}"
        w = [f"{prev}.w{j}" if prev else "0.0e0" for j in range(n)]
        dot = " + ".join(f"{w[j]}*{x[j]}" for j in range(n))
        steps = [f"{w[j]} - {GD_STEP!r}/sqrt({t}.0e0) * avg(({dot} - dur)*{x[j]}) as w{j}" for j in range(n)]
        group = f" group by {', '.join(w)}" if prev else ""
        ctes[f"it{t}"] = f"select {', '.join(steps)} from {src}{group}"
        prev = f"it{t}"
    diff = " + ".join(f"pow(it2.w{j} - it1.w{j}, 2)" for j in range(n))
    norm = " + ".join(f"pow(it2.w{j}, 2)" for j in range(n))
    conv = f"sqrt({diff}) < {linear.CONVERGENCE_TOL!r} * greatest(sqrt({norm}), 1.0e0)"
    cols = ", ".join(f"round(case when {conv} then it2.w{j} else it3.w{j} end, 9) as w_{x[j]}" for j in range(n))
    return bike_sql(f"select case when {conv} then 2 else 3 end as iterations, {cols} from it1, it2, it3",
                    extra=ctes)


@register("gd_linear", _gd_sql())
def q_gd_linear(spark, sf_dir):
    """Full-batch gradient descent from the sufficient statistics (one aggregate)."""
    data = bike_features(spark, sf_dir)
    m = linear.moments(data, GD_FEATURES, LABEL)
    w, done = linear.descend(m, GD_STEP, [GD_ITERS])[GD_ITERS]
    row = [int(done)] + [float(v) for v in w]
    df = spark.createDataFrame([row], "iterations int, " + ", ".join(f"w_{c} double" for c in GD_FEATURES))
    return df.select("iterations", *[r(f"w_{c}", 9).alias(f"w_{c}") for c in GD_FEATURES])


# ------------------------------------------------------------ rows-only fits
@register("split_random", with_views(["trips"], "select count(*) as trips, 0 as in_both, 0 as in_none, "
                                                "true as share_fits from trips"))
def q_split_random(spark, sf_dir):
    """The seeded random split puts every trip into exactly one part, about 70 % of them into the first."""
    t = sv.trips(events(spark, sf_dir))
    train, test = splits.split_random(t, SEED)
    part = lambda df, a, b: df.select("trip_id", F.lit(a).alias("a"), F.lit(b).alias("b"))
    each = part(train, 1, 0).union(part(test, 0, 1)).union(part(t, 0, 0)) \
        .groupBy("trip_id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return each.agg(F.count("*").alias("trips"),
                    F.count_if(F.col("a") + F.col("b") > 1).cast("int").alias("in_both"),
                    F.count_if(F.col("a") + F.col("b") == 0).cast("int").alias("in_none"),
                    F.coalesce(F.abs(F.avg("a") - 0.7) < 0.1, F.lit(True)).alias("share_fits"))


@register("sample_rows")
def q_sample_rows(spark, sf_dir):
    return splits.sample_rows(sv.trips(events(spark, sf_dir)), 0.1, SEED)


@register("sample_fits", with_views(["trips"], "select 0 as strangers, 0 as repeated, true as share_fits from trips limit 1"))
def q_sample_fits(spark, sf_dir):
    """The seeded sample has trips of the table only, none twice, and about a tenth of them."""
    t = sv.trips(events(spark, sf_dir)).select("trip_id")
    each = splits.sample_rows(t, 0.1, SEED).withColumn("a", F.lit(1)).withColumn("b", F.lit(0)) \
        .union(t.withColumn("a", F.lit(0)).withColumn("b", F.lit(1))).groupBy("trip_id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return each.agg(F.count_if(F.col("b") == 0).cast("int").alias("strangers"),
                    F.count_if(F.col("a") > F.col("b")).cast("int").alias("repeated"),
                    (F.abs(F.sum("a") / F.sum("b") - 0.1) < 0.05).alias("share_fits"))


def lloyd_sql(ks, restarts: int, body: str, max_iter: int = clustering.MAX_ITER) -> str:
    """``body`` over the points ``pts`` and the settled centres ``settled`` (k, r, a1, b1, a2, b2, ...) of every cell.

    The loop is a recursion on one row a cell: squared distances, the nearest (lowest on ties), means, and the
    test whether any centre moved.
    """
    most = max(ks)
    js = range(1, most + 1)
    names = ", ".join(f"a{j}, b{j}" for j in js)
    dist = ", ".join(f"coalesce((p.lat-a{j})*(p.lat-a{j}) + (p.lon-b{j})*(p.lon-b{j}), 1e300)" for j in js)
    mean = ", ".join(f"coalesce(sum(lat) filter (cl={j}) / count(*) filter (cl={j}), a{j}) as x{j}, "
                     f"coalesce(sum(lon) filter (cl={j}) / count(*) filter (cl={j}), b{j}) as y{j}" for j in js)
    far = ", ".join(f"coalesce((x{j}-a{j})*(x{j}-a{j}) + (y{j}-b{j})*(y{j}-b{j}), 0e0)" for j in js)
    seeds = ", ".join(f"max(lat) filter (j={j}) as a{j}, max(lon) filter (j={j}) as b{j}" for j in js)
    sql = with_views(["trips"], body, {
        "pts": "select lat2 as lat, lon2 as lon from trips where lat2 is not null and lon2 is not null",
        "ranked": f"""select r, lat, lon, row_number() over (partition by r order by
  {lloyd.point_hash_sql('lat', 'lon', f'{SEED} + r')}, lat, lon) as j
  from (select distinct lat, lon from pts) q, (select unnest(range({restarts})) as r) s""",
        "cells": f"select unnest({list(ks)}) as k",
        "it": f"""select k, r, 0 as n, true as moved, {seeds} from cells, ranked where j <= k group by k, r
 union all
 select k, r, n + 1, greatest({far}) > {lloyd.TOL * lloyd.TOL!r}, {', '.join(f'x{j}, y{j}' for j in js)} from (
  select k, r, n, {names}, {mean} from (
   select it.*, p.lat, p.lon, list_position([{dist}], list_min([{dist}])) as cl
   from it, pts p where it.moved and it.n < {max_iter}) q group by k, r, n, {names}) q""",
        "settled": f"select k, r, {names} from it qualify row_number() over (partition by k, r order by n desc) = 1"})
    return sql.replace("with ", "with recursive ", 1)


def _nearest_sql(lat: str, lon: str, k: int) -> str:
    d = ", ".join(f"({lat}-a{j})*({lat}-a{j}) + ({lon}-b{j})*({lon}-b{j})" for j in range(1, k + 1))
    return f"cast(list_position([{d}], list_min([{d}])) - 1 as double)"


def _elbow_sql() -> str:
    d = ", ".join(f"coalesce((lat-a{j})*(lat-a{j}) + (lon-b{j})*(lon-b{j}), 1e300)" for j in range(1, max(clustering.K_GRID) + 1))
    body = f"""select k, mean_cost, asd, k = (select coalesce(
  (select k - 1 from e where asd is not null and not isnan(asd) order by asd desc, k limit 1), (select min(k) from e))) as is_best
 from (select k, round(mean_cost, 6) as mean_cost, round(asd, 6) as asd from e) q"""
    return lloyd_sql(clustering.K_GRID, clustering.RESTARTS, f""", costs as (
 select k, r, sum(list_min([{d}])) as cost from settled, pts group by k, r),
m as (select k, avg(cost) as mean_cost from costs group by k),
e as (select k, mean_cost, lag(mean_cost, 2) over (order by k) + mean_cost - 2e0*lag(mean_cost, 1) over (order by k) as asd from m)
{body}""")


def _rounded_elbow(elbow):
    return elbow.select("k", r("mean_cost", 6).alias("mean_cost"), r("asd", 6).alias("asd"), "is_best")


@register("kmeans_fit", lloyd_sql([8], 1, f"""select trip_id, {_nearest_sql('lat1', 'lon1', 8)} as km1,
 {_nearest_sql('lat2', 'lon2', 8)} as km2 from trips, settled"""))
def q_kmeans_fit(spark, sf_dir):
    """k-means on trip end points (k = 8), then start/end clusters of every trip."""
    t = sv.trips(events(spark, sf_dir))
    km = clustering.fit_kmeans(t, 8, SEED, max_iter=clustering.MAX_ITER)
    return clustering.assign_clusters(t, clustering.centres_of(km)).select("trip_id", "km1", "km2")


@register("kmeans_select", _elbow_sql())
def q_kmeans_select(spark, sf_dir):
    """Elbow choice of k over k = 6..12: 5 restarts, 200 iterations."""
    t = sv.trips(events(spark, sf_dir))
    _, elbow, _ = clustering.select_k(spark, t, seed=SEED)
    return _rounded_elbow(elbow)


def _split(spark, sf_dir):
    return splits.split_hash(bike_features(spark, sf_dir), "trip_id", 0.7, SEED)


def _flagged(spark, sf_dir):
    """Both halves in one frame."""
    return bike_features(spark, sf_dir).withColumn("is_train", splits.hash_fraction(F.col("trip_id"), SEED) < F.lit(0.7))


@register("fit_dt")
def q_fit_dt(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    m = models.fit_tree(train, BIKE_FEATURES, LABEL, max_depth=4, max_bins=32, seed=SEED)
    return scoring.score_labelled(m, test, BIKE_FEATURES).select("trip_id", "dur", "prediction", "residual")


@register("fit_rf")
def q_fit_rf(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    m = models.fit_forest(train, BIKE_FEATURES, LABEL, num_trees=16, max_depth=6, max_bins=32, seed=SEED)
    return scoring.score_labelled(m, test, BIKE_FEATURES).select("trip_id", "dur", "prediction", "residual")


#: Weights beyond this size only grow: the SQL stops there, before squares overflow.
RUNAWAY = 1e140
#: A cell with a larger error, or none, is reported as infinite.
DIVERGED = 1e15


def _descent_sql(steps, most: int, body: str) -> str:
    """``body`` over the descent ``it`` (step, t, w, ends): one row an iteration and step size, from the moments ``m`` of both
    halves (is_train, n, g, b, yy) over the bike feature rows ``x`` (trip_id, dur, x, is_train)."""
    js = range(1, len(BIKE_FEATURES) + 1)
    xs = ", ".join(f"cast({f} as double)" for f in BIKE_FEATURES)
    gram = ", ".join("[" + ", ".join(f"sum(x[{i}]*x[{j}])" for j in js) + "]" for i in js)
    turn = ", ".join(f"w[{j}] - step/sqrt(t + 1e0) * (list_dot_product(g[{j}], w) - b[{j}])/n" for j in js)
    norm = lambda v: f"sqrt(list_dot_product({v}, {v}))"
    apart = "sqrt(" + " + ".join(f"(nw[{j}] - w[{j}])*(nw[{j}] - w[{j}])" for j in js) + ")"
    size = "greatest(" + ", ".join(f"abs(nw[{j}])" for j in js) + ")"
    return bike_sql(body, extra={
        "x": f"select trip_id, dur, [{xs}] as x, {splits.hash_fraction_sql('trip_id', SEED)} < 0.7 as is_train from f",
        "m": f"""select is_train, count(*) as n, [{gram}] as g, [{', '.join(f'sum(dur*x[{j}])' for j in js)}] as b,
 sum(dur*dur) as yy from x group by is_train""",
        "it": f"""select step, 0 as t, [{', '.join('0e0' for _ in js)}] as w, false as ends
  from (values {', '.join(f'({v!r}::double)' for v in steps)}) v(step)
 union all select step, t + 1, nw, {size} > {RUNAWAY!r}
  or (t > 0 and {apart} < {linear.CONVERGENCE_TOL!r} * greatest({norm('nw')}, 1e0))
  from (select it.*, [{turn}] as nw from it, m where is_train and not ends and t < {most}) q"""
    }).replace("with ", "with recursive ", 1)


def _grid_lr_sql() -> str:
    js = range(1, len(BIKE_FEATURES) + 1)
    mse = f"(list_dot_product(w, [{', '.join(f'list_dot_product(g[{j}], w)' for j in js)}]) - 2*list_dot_product(w, b) + yy)/n"
    cells = ", ".join(f"({i}, {c['iterations']}, {c['step']!r}::double)" for i, c in enumerate(models.default_cells("lr")))
    shown = f"case when {mse} < {DIVERGED!r} then round({mse}, 2) else 'infinity'::double end"
    return _descent_sql(linear.LR_STEPS, max(linear.LR_ITERATIONS), f"""select cell, iterations, step,
 max({shown}) filter (is_train) as train_mse, max({shown}) filter (not is_train) as test_mse from (
  select c.cell, c.iterations, c.step, it.w from (values {cells}) c(cell, iterations, step)
  join it on it.step = c.step and it.t <= c.iterations qualify row_number() over (partition by c.cell order by it.t desc) = 1) q, m
 group by cell, iterations, step""")


@register("fit_lr", _descent_sql([1e-9], 100, """select trip_id, dur, round(list_dot_product(w, x), 4) as prediction,
 round(dur - list_dot_product(w, x), 4) as residual from x, (select w from it order by t desc limit 1) last where not is_train"""))
def q_fit_lr(spark, sf_dir):
    """Held-out trips scored by a linear model of up to 100 steps."""
    train, test = _split(spark, sf_dir)
    m = linear.fit_linear_sgd(train, BIKE_FEATURES, LABEL, iterations=100, step=1e-9)
    return scoring.score_labelled(m, test, BIKE_FEATURES).select(
        "trip_id", "dur", r("prediction", 4).alias("prediction"), r("residual", 4).alias("residual"))


@register("grid_dt")
def q_grid_dt(spark, sf_dir):
    """The full 100-cell tree grid, as ``grid_dt_full``."""
    _, results, _ = models.grid_search(spark, "dt", _flagged(spark, sf_dir), None, BIKE_FEATURES, LABEL, seed=SEED)
    return results


@register("grid_dt_full")
def q_grid_dt_full(spark, sf_dir):
    """The full 100-cell tree grid: one deep tree for each number of bins."""
    _, results, _ = models.grid_search(spark, "dt", _flagged(spark, sf_dir), None, BIKE_FEATURES, LABEL, seed=SEED)
    return results


@register("grid_rf")
def q_grid_rf(spark, sf_dir):
    """The full 560-cell forest grid: one forest for each number of bins, whose prefixes and cuts are the cells."""
    _, results, _ = models.grid_search(spark, "rf", _flagged(spark, sf_dir), None, BIKE_FEATURES, LABEL, seed=SEED)
    return results


@register("grid_lr", _grid_lr_sql())
def q_grid_lr(spark, sf_dir):
    """The full 30-cell linear grid: one aggregate for both halves.  Cells whose steps are too large diverge."""
    _, results, _ = models.grid_search(spark, "lr", _flagged(spark, sf_dir), None, BIKE_FEATURES, LABEL)
    shown = lambda c: F.when(F.col(c) < DIVERGED, r(c, 2)).otherwise(float("inf")).alias(c)
    return results.select("cell", "iterations", "step", shown("train_mse"), shown("test_mse"))


def _differing(a, b, algo: str):
    """How many rows two scorings share, and how many they score differently."""
    both = a.select("trip_id", F.col("prediction").alias("a")).join(
        b.select("trip_id", F.col("prediction").alias("b")), "trip_id")
    return both.agg(F.lit(algo).alias("algo"), F.count("*").alias("held_out"),
                    F.count_if(~F.col("a").eqNullSafe(F.col("b"))).cast("int").alias("differing"))


@register("model_roundtrip", bike_sql(f"""select algo, count(trip_id) as held_out, 0 as differing
 from (values ('dt'), ('rf'), ('lr')) as v(algo) left join f on {splits.hash_fraction_sql('trip_id', SEED)} >= 0.7
 group by algo"""))
def q_model_roundtrip(spark, sf_dir):
    """A saved and reloaded tree, forest and linear model score every held-out row as before."""
    train, test = _split(spark, sf_dir)
    fits = {"dt": models.fit_tree(train, BIKE_FEATURES, LABEL, max_depth=5, max_bins=32, seed=SEED),
            "rf": models.fit_forest(train, BIKE_FEATURES, LABEL, num_trees=4, max_depth=4, max_bins=32, seed=SEED),
            "lr": linear.LinearModel(BIKE_FEATURES, BIKE_WEIGHTS)}
    score = lambda m: scoring.score_unlabelled(m, test, BIKE_FEATURES)
    parts = []
    for algo, m in fits.items():
        path = models.save_model(spark, m, scratch_path(spark, f"{algo}-model"))
        parts.append(_differing(score(m), score(models.load_model(spark, path, algo)), algo))
    return parts[0].union(parts[1]).union(parts[2])


@register("kmeans_roundtrip", with_views(["trips"], "select count(*) as trips, 0 as differing from trips"))
def q_kmeans_roundtrip(spark, sf_dir):
    """A saved and reloaded k-means model assigns every trip's end points as before."""
    t = sv.trips(events(spark, sf_dir))
    km = clustering.fit_kmeans(t, 8, SEED, max_iter=clustering.MAX_ITER)
    path = models.save_model(spark, km, scratch_path(spark, "km-model"))
    back = models.load_model(spark, path, "km")
    first = clustering.assign_clusters(t, clustering.centres_of(km)).select("trip_id", "km1", "km2")
    again = clustering.assign_clusters(t, clustering.centres_of(back)).select("trip_id", F.col("km1").alias("b1"), F.col("km2").alias("b2"))
    same = F.col("km1").eqNullSafe(F.col("b1")) & F.col("km2").eqNullSafe(F.col("b2"))
    return first.join(again, "trip_id").agg(F.count("*").alias("trips"), F.count_if(~same).cast("int").alias("differing"))


@register("fit_dt_leaves", bike_sql(f"""select count(*) as trained, 0 as wrong_leaves
 from f where {splits.hash_fraction_sql('trip_id', SEED)} < 0.7"""))
def q_fit_dt_leaves(spark, sf_dir):
    """Every leaf of a fitted tree predicts the mean duration of its training rows."""
    train, _ = _split(spark, sf_dir)
    m = models.fit_tree(train, BIKE_FEATURES, LABEL, max_depth=4, max_bins=32, seed=SEED)
    leaves = scoring.score_labelled(m, train, BIKE_FEATURES).groupBy("prediction").agg(
        F.count("*").alias("n"), F.avg("dur").alias("mean"))
    off = F.abs(F.col("mean") - F.col("prediction")) > 1e-9 * F.abs(F.col("mean"))
    return leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("trained"), F.count_if(off).cast("int").alias("wrong_leaves"))


SPLIT_BINS = 32


def _splits_sql() -> str:
    """The best split of the root and of its children by a search over all quantile thresholds."""
    feats = ", ".join(f"cast({f} as double)" for f in BIKE_FEATURES)
    names = ", ".join(f"'{f}'" for f in BIKE_FEATURES)

    def level(rows: str) -> str:
        return f"""select node, f, t, n, sl*sl/nl + (s - sl)*(s - sl)/(n - nl) - s*s/n as gain from (
  select r.node, r.f, c.t, sum(dur) as s, cast(count(*) as double) as n, sum(dur) filter (x <= t) as sl,
   cast(count(*) filter (x <= t) as double) as nl from {rows} r join cuts c on c.f = r.f group by r.node, r.f, c.t) q
 where nl > 0 and nl < n qualify row_number() over (partition by node order by gain desc, f, t) = 1"""
    return bike_sql(f"""select cast(node as int) as node, list_extract([{names}], f + 1) as feature, t as threshold,
 cast(n as bigint) as trips from (select * from root union all select * from children) q""", extra={
        "fr": f"""select trip_id, dur, 1 as node, unnest([{feats}]) as x, unnest(range({len(BIKE_FEATURES)})) as f
  from f where {splits.hash_fraction_sql('trip_id', SEED)} < 0.7""",
        "ranked": "select f, x, row_number() over (partition by f order by x) as rn, count(*) over (partition by f) as n from fr",
        "cuts": f"""select distinct f, x as t from ranked, (select unnest(range(1, {SPLIT_BINS})) as i) b
  where rn = ceil(i / {SPLIT_BINS}e0 * n)""",
        "root": level("fr"),
        "side": "select trip_id, case when x <= t then 2 else 3 end as node from fr join root on root.f = fr.f",
        "below": "select fr.trip_id, dur, side.node, x, f from fr join side on side.trip_id = fr.trip_id",
        "children": level("below")})


@register("fit_dt_splits", _splits_sql())
def q_fit_dt_splits(spark, sf_dir):
    """Feature, threshold and training trips of the first two levels of a fitted tree."""
    rows = trees.numbered(_flagged(spark, sf_dir), BIKE_FEATURES, LABEL)
    cuts = trees.thresholds(rows.where("is_train"), BIKE_FEATURES, [SPLIT_BINS])[SPLIT_BINS]
    grown = trees.fit(rows, BIKE_FEATURES, LABEL, [0], 2, cuts, SEED).nodes[0]
    out = [(i, BIKE_FEATURES[f], float(cuts[f][k]), int(n)) for i, (n, _, f, k) in grown.items() if i < 4 and f >= 0]
    return spark.createDataFrame(out, "node int, feature string, threshold double, trips long")


@register("fit_rf_trees", bike_sql(f"""select count(*) as held_out, 0 as not_the_mean, 0 as not_the_prefix
 from f where {splits.hash_fraction_sql('trip_id', SEED)} >= 0.7"""))
def q_fit_rf_trees(spark, sf_dir):
    """A forest predicts the mean of its trees, and the forest of its first two trees is the one fitted with two."""
    _, test = _split(spark, sf_dir)
    rows = trees.numbered(_flagged(spark, sf_dir), BIKE_FEATURES, LABEL)  # draws belong to numbered rows
    cuts = trees.thresholds(rows.where("is_train"), BIKE_FEATURES, [SPLIT_BINS])[SPLIT_BINS]
    forest, two = (trees.fit(rows, BIKE_FEATURES, LABEL, range(1, n + 1), 4, cuts, SEED).model(n, 4) for n in (4, 2))
    df = two.transform(forest.transform(test), "two")
    for i, t in enumerate(forest.trees):
        df = trees.TreeModel(BIKE_FEATURES, [t]).transform(df, f"tree_{i}")
    mean = lambda n: sum((F.col(f"tree_{i}") for i in range(n)), F.lit(0.0)) / n
    off = lambda a, b: F.count_if(F.abs(a - b) > 1e-9 * F.abs(b)).cast("int")
    return df.agg(F.count("*").alias("held_out"), off(F.col("prediction"), mean(4)).alias("not_the_mean"),
                  off(F.col("two"), mean(2)).alias("not_the_prefix"))


SHALLOW = [dict(max_depth=d, max_bins=b) for d in (1, 2) for b in models.DT_BINS]


def _shallow_grid_sql() -> str:
    """Errors of the grid's trees cut at one and two levels, for all bin counts: thresholds by rank, splits from running sums."""
    n = len(BIKE_FEATURES)
    xs = ", ".join(f"cast({f} as double)" for f in BIKE_FEATURES)
    bins = ", ".join(f"({b})" for b in models.DT_BINS)

    def running(rows: str, by: str) -> str:
        over = f"over (partition by {by} order by v)"
        return f"select {by}, v, sum(c) {over} as nl, sum(s) {over} as sl from (select {by}, v, count(*)::double as c, sum(dur) as s from {rows} group by {by}, v) q"

    def best(found: str, by: str) -> str:
        return f"""select {by}, f, t from (select *, sl*sl/nl + (s - sl)*(s - sl)/(n - nl) - s*s/n as gain from ({found}) q
  where nl > 0 and nl < n) q where gain > 1e-12 * greatest(1, s*s/n) qualify row_number() over (partition by {by} order by gain desc, f, t) = 1"""

    def error(node: str, depth: int) -> str:
        return f"""select b, {depth} as depth, is_train, avg((dur - mean)*(dur - mean)) as mse from leaf join
  (select b, {node} as place, sum(dur)/count(*) as mean from leaf where is_train group by b, {node}) q using (b)
  where place = {node} group by b, is_train"""

    cells = ", ".join(f"({i}, {c['max_depth']}, {c['max_bins']})" for i, c in enumerate(SHALLOW))
    return bike_sql(f"""select cell, max_depth, max_bins, max(round(mse, 2)) filter (is_train) as train_mse,
 max(round(mse, 2)) filter (not is_train) as test_mse
 from (values {cells}) c(cell, max_depth, max_bins) join ({error('node', 1)} union all {error('under', 2)}) e
 on e.b = max_bins and e.depth = max_depth group by cell, max_depth, max_bins""", extra={
        "bins": f"select b from (values {bins}) v(b)",
        "x": f"select trip_id, dur, [{xs}] as x, {splits.hash_fraction_sql('trip_id', SEED)} < 0.7 as is_train from f",
        "fr": f"select dur, unnest(x) as v, unnest(range({n})) as f from x where is_train",
        "ranked": "select f, v, row_number() over (partition by f order by v) as rn, count(*) over (partition by f) as n from fr",
        "cuts": """select distinct b, f, v as t from ranked join (select b, unnest(range(1, b)) as i from bins) i
  on rn = ceil(i / b::double * n)""",
        "sums": running("fr", "f"),
        "root": best("""select c.b, c.f, c.t, nl, sl, w.n, w.s from cuts c join sums on sums.f = c.f and sums.v = c.t,
   (select count(*)::double as n, sum(dur) as s from x where is_train) w""", "b"),
        "side": """select x.*, bins.b, case when root.f is null then 1 when x.x[root.f + 1] <= root.t then 2 else 3 end as node
  from x cross join bins left join root on root.b = bins.b""",
        "below": f"select b, node, dur, unnest(x) as v, unnest(range({n})) as f from side where is_train and node > 1",
        "sums_below": running("below", "b, node, f"),
        "child": best("""select c.b, c.node, c.f, c.t, p.nl, p.sl, c.n, c.s from
   (select cuts.b, w.node, cuts.f, cuts.t, w.n, w.s from cuts join (select b, node, count(*)::double as n, sum(dur) as s
     from side where is_train group by b, node) w on w.b = cuts.b where w.node > 1) c
   asof join sums_below p on p.b = c.b and p.node = c.node and p.f = c.f and c.t >= p.v""", "b, node"),
        "leaf": """select side.b, dur, is_train, side.node, case when child.f is null then side.node when x[child.f + 1] <= child.t
  then 2*side.node else 2*side.node + 1 end as under from side left join child on child.b = side.b and child.node = side.node"""})


@register("grid_dt_shallow", _shallow_grid_sql())
def q_grid_dt_shallow(spark, sf_dir):
    """Errors on both halves of the tree grid's cells at depths one and two, all bin counts, against a search in SQL."""
    _, results, _ = models.grid_search(spark, "dt", _flagged(spark, sf_dir), None, BIKE_FEATURES, LABEL, SHALLOW, SEED)
    return results.select("cell", "max_depth", "max_bins", r("train_mse", 2).alias("train_mse"), r("test_mse", 2).alias("test_mse"))


#: A printed tree over the bike features, and the same as SQL.
PRINTED_TREE = """Tree of depth 3
  If (feature 10 <= 15000.0)
   If (feature 1 <= 0.5)
    Predict: 400.5
   Else (feature 1 > 0.5)
    If (feature 13 <= 1960.0)
     Predict: 512.25
    Else (feature 13 > 1960.0)
     Predict: 470.125
  Else (feature 10 > 15000.0)
   If (feature 12 <= 0.0)
    Predict: 1500.0
   Else (feature 12 > 0.0)
    Predict: 1750.75
"""
PRINTED_SQL = """case when dist <= 15000 then case when tm <= 0.5 then 400.5e0 when yr <= 1960 then 512.25e0 else 470.125e0 end
 when peak <= 0 then 1500e0 else 1750.75e0 end"""


@register("score_printed_tree", bike_sql(f"select trip_id, dur, {PRINTED_SQL} as prediction, dur - {PRINTED_SQL} as residual from f"))
def q_score_printed_tree(spark, sf_dir):
    """A tree given in printed form scores the labelled rows."""
    model = trees.TreeModel(BIKE_FEATURES, trees.parse_printed(PRINTED_TREE))
    return scoring.score_labelled(model, bike_features(spark, sf_dir), BIKE_FEATURES).select("trip_id", "dur", "prediction", "residual")


@register("stream_predict", bike_sql(f"select round({linear_sql()}, 6) as prediction from f", False))
def q_stream_predict(spark, sf_dir):
    """Unlabelled bike trip files scored by a streaming query with the linear model."""
    from tripwise.streaming import start_prediction_stream
    from tripwise.sources import writers
    cols = ["dt", "time", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"]
    src = writers.write_csv(sv.bike_trips(events(spark, sf_dir), False).select(*cols), scratch_path(spark, "stream-in"))
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    w = weather_df(spark, sf_dir).persist()
    try:
        q = start_prediction_stream(spark, src, w, linear.LinearModel(BIKE_FEATURES, BIKE_WEIGHTS),
                                    sv.fixed_centres(N_CENTRES), "bike", sink, ckpt)
        q.awaitTermination()
    finally:
        w.unpersist()
    return spark.read.parquet(sink).select(r("prediction", 6).alias("prediction"))


#: A second printed tree, so that two make a forest.
SECOND_TREE = """Tree of depth 2
  If (feature 0 <= 0.25)
   Predict: 640.5
  Else (feature 0 > 0.25)
   If (feature 2 <= 40.75)
    Predict: 810.25
   Else (feature 2 > 40.75)
    Predict: 905.5
"""
SECOND_SQL = "case when days <= 0.25 then 640.5e0 when lat1 <= 40.75 then 810.25e0 else 905.5e0 end"
TAXI_WEIGHTS = [round(0.01 + 0.003 * i, 6) for i in range(len(TAXI_FEATURES))]
TRIP_COLUMNS = {"bike": ["dt", "time", "dur", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"],
                "taxi": ["dt", "time", "dur", "lat1", "lon1", "lat2", "lon2", "psg"]}
FEATURES = {"bike": BIKE_FEATURES, "taxi": TAXI_FEATURES}


def _given_model(dataset: str, algo: str, factor: float = 1.0):
    """A model that needs no training."""
    if algo == "lr":
        return linear.LinearModel(FEATURES[dataset], [factor * w for w in (BIKE_WEIGHTS if dataset == "bike" else TAXI_WEIGHTS)])
    printed = [PRINTED_TREE if dataset == "bike" else SECOND_TREE] + [SECOND_TREE] * (algo == "rf")
    return trees.TreeModel(FEATURES[dataset], [t for p in printed for t in trees.parse_printed(p)])


def _given_sql(dataset: str, algo: str) -> str:
    if algo == "lr":
        return linear_sql() if dataset == "bike" else " + ".join(f"{w!r}*{f}" for w, f in zip(TAXI_WEIGHTS, TAXI_FEATURES))
    first = PRINTED_SQL if dataset == "bike" else SECOND_SQL
    return f"({first} + {SECOND_SQL})/2" if algo == "rf" else first


def _published(spark, dataset: str, algo: str, factor: float = 1.0, to: tuple[str, str] | None = None) -> tuple[str, str]:
    """Folders of a published training whose model and clusters are given."""
    from tripwise.plans import bundle
    model_dir, km_dir = to or (scratch_path(spark, "given-model"), scratch_path(spark, "given-km"))
    bundle.publish(spark, model_dir, km_dir, algo, clustering.CentreModel(sv.fixed_centres(N_CENTRES)),
                   _given_model(dataset, algo, factor), dict(split="hash", seed=SEED, train_fraction=0.7))
    return model_dir, km_dir


def _trip_files(spark, sf_dir, dataset: str, labelled: bool, where: str = "true") -> tuple[str, str]:
    from tripwise.sources import writers
    ev = events(spark, sf_dir)
    cols = [c for c in TRIP_COLUMNS[dataset] if labelled or c != "dur"]
    return (writers.write_csv(sv.weather(ev), scratch_path(spark, "s-weather"), header=True),
            writers.write_csv(sv.trips(ev).where(where).select(*cols), scratch_path(spark, "s-trips")))


def _scored_sql(dataset: str, algo: str) -> str:
    p = _given_sql(dataset, algo)
    return feature_rows_sql(FEATURES[dataset], True, f"""select t.dt, f.dur, round({p}, 6) as prediction,
 round(f.dur - ({p}), 6) as residual from (select * from f) f join (select trip_id as id, dt from trips) t on t.id = f.trip_id""")


def _register_scored(dataset: str, algo: str) -> None:
    @register(f"scored_output_{dataset}_{algo}", _scored_sql(dataset, algo))
    def query(spark, sf_dir):
        """What test mode writes for whole trip files, read back: a published model of each kind for both kinds of trips."""
        from tripwise.plans import pipeline
        weather, trips = _trip_files(spark, sf_dir, dataset, True)
        out = pipeline.run(spark, weather, trips, *_published(spark, dataset, algo), dataset, algo, "test")
        return spark.read.schema(out["schema"]).parquet(out["path"]).select(
            "dt", "dur", r("prediction", 6).alias("prediction"), r("residual", 6).alias("residual"))


for _dataset in FEATURES:
    for _algo in ("dt", "rf", "lr"):
        _register_scored(_dataset, _algo)


RESCORED = "day(dt) in (5, 17)"


@register("rescored_days", bike_sql(f"""select dt, round(case when {RESCORED} then 2 else 1 end * p, 6) as prediction
 from (select t.dt, {linear_sql()} as p from (select * from f) f join (select trip_id as id, dt from trips) t on t.id = f.trip_id) q""", False))
def q_rescored_days(spark, sf_dir):
    """Prediction mode over all trips, then a newer model over two days of each month, which alone are replaced."""
    from tripwise.plans import pipeline
    weather, trips = _trip_files(spark, sf_dir, "bike", False)
    dirs = _published(spark, "bike", "lr")
    pipeline.run(spark, weather, trips, *dirs, "bike", "lr", "prediction")
    _published(spark, "bike", "lr", 2.0, dirs)
    weather, again = _trip_files(spark, sf_dir, "bike", False, RESCORED)
    out = pipeline.run(spark, weather, again, *dirs, "bike", "lr", "prediction", pipeline.RunOptions(replace="days"))
    return spark.read.schema(out["schema"]).parquet(out["path"]).select("dt", r("prediction", 6).alias("prediction"))


def _train_test_predict(spark, sf_dir, dataset: str, algo: str):
    from tripwise.plans import pipeline
    weather, trips = _trip_files(spark, sf_dir, dataset, True)
    _, unl = _trip_files(spark, sf_dir, dataset, False)
    model_dir, km_dir = scratch_path(spark, "p-model"), scratch_path(spark, "p-km")
    opts = pipeline.RunOptions(seed=SEED)
    pipeline.run(spark, weather, trips, model_dir, km_dir, dataset, algo, "training", opts)
    pipeline.run(spark, weather, trips, model_dir, km_dir, dataset, algo, "test", opts)
    out = pipeline.run(spark, weather, unl, model_dir, km_dir, dataset, algo, "prediction", opts)
    return spark.read.schema(out["schema"]).parquet(out["path"])


@register("train_test_predict")
def q_train_test_predict(spark, sf_dir):
    """The whole pipeline on bike trip files: choose clusters over all 35 fits, search the full
    100-cell tree grid, score the labelled rows (test mode) and predict unlabelled ones."""
    return _train_test_predict(spark, sf_dir, "bike", "dt")


@register("train_test_predict_taxi_lr")
def q_train_test_predict_taxi_lr(spark, sf_dir):
    """The whole pipeline on taxi trip files with the full search of clusters and the 30-cell linear grid."""
    return _train_test_predict(spark, sf_dir, "taxi", "lr")


@register("kmeans_select_weighted", _elbow_sql())
def q_kmeans_select_weighted(spark, sf_dir):
    """Elbow choice of k with the end points reduced to distinct coordinates weighted
    by their counts (the station-based variant; 5 restarts, 200 iterations)."""
    t = sv.trips(events(spark, sf_dir))
    _, elbow, _ = clustering.select_k(spark, t, seed=SEED, weighted=True)
    return _rounded_elbow(elbow)
