"""Registered checks: one Spark query per operator, each with the DuckDB SQL
that must give the same rows (where the result is deterministic).

Every query reads the driver's tables (through the stand-in views) in full.
Doubles that pass through trigonometry or a floating-point average are
rounded in the final projection, identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.functions import (cartesian, chord_distance, day_fraction_of_time, day_of_year_fraction,
                                peak_flag, weekday_flag)
from tripwise.operators import clustering, joins, outliers
from tripwise.plans.features import BIKE_FEATURES, TAXI_FEATURES, build_features
from tripwise.session import scratch_path
from tripwise.sources import standins as sv
from tripwise.sources.standin_sql import centres_values, with_views

from tripwise.checks.registry import events, r, register, weather_df


# ---------------------------------------------------------------- SQL pieces
TM = "(ss + mi*60 + hh*3600)/86400.0e0"
DAYS = "cast(dayofyear(dt) as double)/cast(dayofyear(make_date(year(dt),12,31)) as double)"
WEEKDAY = "case when isodow(dt) <= 5 then 1.0e0 else 0.0e0 end"
PEAK = ("case when isodow(dt) <= 5 and ((tm >= 21600/86400.0e0 and tm <= 36000/86400.0e0) or "
        "(tm >= 57600/86400.0e0 and tm <= 72000/86400.0e0)) then 1.0e0 else 0.0e0 end")


def xyz(lat: str, lon: str) -> tuple[str, str, str]:
    return (f"cos(radians({lat}))*cos(radians({lon}))", f"cos(radians({lat}))*sin(radians({lon}))",
            f"sin(radians({lat}))")


def dist_sql(a=("lat1", "lon1"), b=("lat2", "lon2")) -> str:
    x1, y1, z1 = xyz(*a)
    x2, y2, z2 = xyz(*b)
    return f"sqrt(pow({x1}-{x2},2)+pow({y1}-{y2},2)+pow({z1}-{z2},2))*6371000.0e0"


def nearest_sql(src: str, lat: str, lon: str, out: str, n: int) -> str:
    return (f"select trip_id, cast(k as double) as {out} from (select t.trip_id, c.k, row_number() over "
            f"(partition by t.trip_id order by pow(t.{lat}-c.clat,2)+pow(t.{lon}-c.clon,2), c.k) as rn "
            f"from {src} t, centres c) where rn = 1")


N_CENTRES = 8
FEATURE_VIEWS = {
    "centres": centres_values(N_CENTRES),
    "t": f"select *, {TM} as tm from trips",
    "c1": nearest_sql("t", "lat1", "lon1", "km1", N_CENTRES),
    "c2": nearest_sql("t", "lat2", "lon2", "km2", N_CENTRES),
}


def joined_sql(feats: list[str], labelled: bool) -> str:
    exprs = {"days": DAYS, "dist": dist_sql(), "weekday": WEEKDAY, "peak": PEAK,
             "temp": "w.temp", "rain": "w.rain", "snow": "w.snow", "wspd": "w.wspd",
             "km1": "c1.km1", "km2": "c2.km2"}
    cols = ["t.trip_id"] + (["t.dur"] if labelled else [])
    cols += [f"{exprs.get(f, 't.' + f)} as {f}" for f in feats]
    return ("select " + ", ".join(cols) + " from t join weather w using (dt) "
            "join c1 on c1.trip_id = t.trip_id join c2 on c2.trip_id = t.trip_id")


def sigma_sql(inner: str) -> str:
    return (f"with bounded as materialized ({inner}) select j.* from bounded j, "
            "(select avg(dist/dur) as m, stddev_pop(dist/dur) as sd from bounded) s "
            "where dist/dur < m + 3*sd and dist/dur > m - 3*sd")


def rounded_select(cols: list[str]) -> str:
    out = []
    for c in cols:
        if c == "dist":
            out.append("round(dist, 2) as dist")
        elif c == "temp":
            out.append("round(temp, 6) as temp")
        else:
            out.append(c)
    return ", ".join(out)


def rounded_cols(cols: list[str]):
    return [r("dist", 2).alias("dist") if c == "dist" else r("temp", 6).alias("temp") if c == "temp"
            else F.col(c) for c in cols]


def feature_rows_sql(feats: list[str], labelled: bool, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` run over the (unrounded) feature rows, available as the view ``f``."""
    inner = joined_sql(feats, labelled)
    if labelled:
        inner = sigma_sql(f"select * from ({inner}) where dur >= 120 and dur <= 3600")
    return with_views(["trips", "weather"], body, {**FEATURE_VIEWS, "f": inner, **(extra or {})})


def feature_sql(feats: list[str], labelled: bool) -> str:
    inner = joined_sql(feats, labelled)
    if labelled:
        inner = sigma_sql(f"select * from ({inner}) where dur >= 120 and dur <= 3600")
    cols = ["trip_id"] + (["dur"] if labelled else []) + feats
    return with_views(["trips", "weather"], f"select {rounded_select(cols)} from ({inner}) q", FEATURE_VIEWS)


# ------------------------------------------------------- 1. acceptance slice
ACCEPT_SQL = with_views(["trips", "weather"], """select trip_id, round(dist,2) as dist, psg, yr from j, s
where dist/dur < m+3*sd and dist/dur > m-3*sd""", {
    "j": f"""select t.*, temp, rain, snow, wspd, {dist_sql()} as dist
 from trips t join weather w on t.dt=w.dt where dur>=120 and dur<=3600""",
    "s": "select avg(dist/dur) as m, stddev_pop(dist/dur) as sd from j"})


@register("speed_3sigma", ACCEPT_SQL)
def q_speed_3sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips joined to weather, bounded, chord distance, 3-sigma speed filter."""
    t = sv.trips(events(spark, sf_dir))
    j = joins.join_weather(t, weather_df(spark, sf_dir))
    j = outliers.duration_closed(j).withColumn(
        "dist", chord_distance(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))
    return outliers.speed_3sigma(j).select("trip_id", r("dist", 2).alias("dist"), "psg", "yr")


@register("speed_stats", with_views(["trips", "weather"], f"""
select round(avg(d/dur), 6) as speed_avg, round(stddev_pop(d/dur), 6) as speed_sd
from (select dur, {dist_sql()} as d from trips t join weather w on t.dt = w.dt where dur >= 120 and dur <= 3600) q"""))
def q_speed_stats(spark, sf_dir):
    j = outliers.duration_closed(joins.join_weather(sv.trips(events(spark, sf_dir)), weather_df(spark, sf_dir)))
    j = j.withColumn("dist", chord_distance(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))
    s = outliers.speed_stats(j)
    return s.select(r("speed_avg", 6).alias("speed_avg"), r("speed_sd", 6).alias("speed_sd"))


@register("speed_stats_incremental", with_views(["trips", "weather"], f"""
select round(avg(d/dur), 6) as speed_avg, round(stddev_pop(d/dur), 6) as speed_sd, count(distinct dt) as days
from (select t.dt, dur, {dist_sql()} as d from trips t join weather w on t.dt = w.dt where dur >= 120 and dur <= 3600) q"""))
def q_speed_stats_incremental(spark, sf_dir):
    """The statistics from states of three batches of trips, kept as a table to which each batch is added."""
    j = outliers.duration_closed(joins.join_weather(sv.trips(events(spark, sf_dir)), weather_df(spark, sf_dir)))
    j = j.withColumn("dist", chord_distance(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))
    path = scratch_path(spark, "speed-state")
    for batch in range(3):
        outliers.day_moments(j.where(F.col("trip_id") % 3 == batch)).write.mode("append").parquet(path)
    days = outliers.merge_moments(spark.read.parquet(path))
    s = outliers.stats_of_moments(days)
    return s.select(r("speed_avg", 6).alias("speed_avg"), r("speed_sd", 6).alias("speed_sd"),
                    F.lit(days.count()).cast("long").alias("days"))


@register("duration_closed", with_views(["trips", "weather"],
          "select trip_id, dur from trips t join weather w on t.dt = w.dt where dur >= 120 and dur <= 3600"))
def q_duration_closed(spark, sf_dir):
    j = joins.join_weather(sv.trips(events(spark, sf_dir)), weather_df(spark, sf_dir))
    return outliers.duration_closed(j).select("trip_id", "dur")


# ---------------------------------------------------------- 2. scalar functions
@register("f_day_of_year", with_views(["trips"], f"select trip_id, {DAYS} as days from trips"))
def q_f_day_of_year(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return t.select("trip_id", day_of_year_fraction(F.col("dt")).alias("days"))


@register("f_day_fraction", with_views(["trips"], f"select trip_id, {TM} as tm from trips"))
def q_f_day_fraction(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return t.select("trip_id", day_fraction_of_time(F.col("time")).alias("tm"))


@register("f_weekday", with_views(["trips"], f"select trip_id, {WEEKDAY} as weekday from trips"))
def q_f_weekday(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return t.select("trip_id", weekday_flag(F.col("dt")).alias("weekday"))


@register("f_peak", with_views(["trips"], f"select trip_id, {PEAK} as peak from (select *, {TM} as tm from trips) q"))
def q_f_peak(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return t.select("trip_id", peak_flag(F.col("dt"), day_fraction_of_time(F.col("time"))).alias("peak"))


@register("f_cartesian", with_views(["trips"], "select trip_id, " + ", ".join(
    f"round({e}, 9) as {n}" for e, n in zip(xyz("lat1", "lon1"), ("x", "y", "z"))) + " from trips"))
def q_f_cartesian(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    x, y, z = cartesian(F.col("lat1"), F.col("lon1"))
    return t.select("trip_id", r(x, 9).alias("x"), r(y, 9).alias("y"), r(z, 9).alias("z"))


@register("f_chord_distance", with_views(["trips"], f"select trip_id, round({dist_sql()}, 2) as dist from trips"))
def q_f_chord_distance(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    d = chord_distance(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return t.select("trip_id", r(d, 2).alias("dist"))


# ------------------------------------------------------------------ 3. joins
def _join_cols(labelled: bool, bike: bool) -> list[str]:
    base = sv.BIKE_COLS if bike else sv.TAXI_COLS
    return [c for c in base if labelled or c != "dur"]


def _join_q(labelled: bool, bike: bool):
    def q(spark, sf_dir):
        ev = events(spark, sf_dir)
        t = sv.bike_trips(ev, labelled) if bike else sv.taxi_trips(ev, labelled)
        j = joins.join_weather(t, weather_df(spark, sf_dir))
        cols = _join_cols(labelled, bike)
        return j.select(*cols, r("temp", 6).alias("temp"), "rain", "snow", "wspd")
    return q


def _join_sql(labelled: bool, bike: bool) -> str:
    cols = ", ".join(f"t.{c}" for c in _join_cols(labelled, bike))
    return with_views(["trips", "weather"], f"select {cols}, round(w.temp, 6) as temp, w.rain, w.snow, w.wspd "
                      "from trips t join weather w on t.dt = w.dt")


register("join_weather_taxi", _join_sql(True, False))(_join_q(True, False))
register("join_weather_bike", _join_sql(True, True))(_join_q(True, True))
register("join_weather_pred", _join_sql(False, False))(_join_q(False, False))


# ------------------------------------------------------- 4. feature projections
def _features_q(dataset: str, labelled: bool):
    feats = TAXI_FEATURES if dataset == "taxi" else BIKE_FEATURES

    def q(spark, sf_dir):
        ev = events(spark, sf_dir)
        t = sv.taxi_trips(ev, labelled) if dataset == "taxi" else sv.bike_trips(ev, labelled)
        f = build_features(t, weather_df(spark, sf_dir), sv.fixed_centres(N_CENTRES), dataset, labelled)
        return f.select(*rounded_cols(["trip_id"] + (["dur"] if labelled else []) + feats))
    return q


for _ds in ("taxi", "bike"):
    register(f"features_{_ds}", feature_sql(TAXI_FEATURES if _ds == "taxi" else BIKE_FEATURES, True))(
        _features_q(_ds, True))
    register(f"features_{_ds}_pred", feature_sql(TAXI_FEATURES if _ds == "taxi" else BIKE_FEATURES, False))(
        _features_q(_ds, False))


# --------------------------------------------------------- 5. fixed clusters
@register("assign_clusters", with_views(["trips"], """select t.trip_id, c1.km1, c2.km2
 from t join c1 on c1.trip_id = t.trip_id join c2 on c2.trip_id = t.trip_id""", FEATURE_VIEWS))
def q_assign_clusters(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return clustering.assign_clusters(t, sv.fixed_centres(N_CENTRES)).select("trip_id", "km1", "km2")


@register("kmeans_cost", with_views(["trips"], """select round(sum(d2), 6) as cost from (
 select t.trip_id, min(pow(t.lat2-c.clat,2)+pow(t.lon2-c.clon,2)) as d2 from trips t, centres c group by t.trip_id) q""",
                                    {"centres": centres_values(N_CENTRES)}))
def q_kmeans_cost(spark, sf_dir):
    t = sv.trips(events(spark, sf_dir))
    return clustering.kmeans_cost(t, sv.fixed_centres(N_CENTRES)).select(r("cost", 6).alias("cost"))


ELBOW_KS = clustering.K_GRID


# Restart r of k uses the first k fixed centres moved by r * 0.01 degrees in latitude.
ELBOW_RESTARTS = clustering.RESTARTS


def restart_centres(k: int, r: int):
    return [(round(a + 0.01 * r, 2), b) for a, b in sv.fixed_centres(max(ELBOW_KS))[:k]]


def _restart_values() -> str:
    rows = ", ".join(f"({r}, {i}, {a!r}, {b!r})" for r in range(ELBOW_RESTARTS)
                     for i, (a, b) in enumerate(restart_centres(max(ELBOW_KS), r)))
    return f"select * from (values {rows}) as c(r, k, clat, clon)"


ELBOW_SQL = with_views(["trips"], """select k, round(mean_cost, 6) as mean_cost, round(asd, 6) as asd,
 k = (select best_k from b) as is_best from e""", {
    "centres": _restart_values(),
    "ks": "select unnest(" + str(list(ELBOW_KS)) + ") as k",
    "costs": """select k, r, sum(d2) as cost from (
  select t.trip_id, g.k, c.r, min(pow(t.lat2-c.clat,2)+pow(t.lon2-c.clon,2)) as d2
  from trips t, ks g, centres c where c.k < g.k group by t.trip_id, g.k, c.r) q group by k, r""",
    "m": "select k, avg(cost) as mean_cost from costs group by k",
    "e": """select k, mean_cost,
  lag(mean_cost, 2) over (order by k) + mean_cost - 2.0e0*lag(mean_cost, 1) over (order by k) as asd from m""",
    "b": """select coalesce((select k - 1 from e where asd is not null and not isnan(asd) order by asd desc, k limit 1),
                       (select min(k) from e)) as best_k"""})


@register("elbow_select", ELBOW_SQL)
def q_elbow_select(spark, sf_dir):
    """Elbow choice of k over a (k, restart) cost table (mean over restarts per k);
    restart r of k = the first k fixed centres shifted by r * 0.01 in latitude."""
    t = sv.trips(events(spark, sf_dir))
    costs = clustering.cost_table(t, {(k, r): restart_centres(k, r) for k in ELBOW_KS for r in range(ELBOW_RESTARTS)})
    e = clustering.elbow_table(costs)
    return e.select("k", r("mean_cost", 6).alias("mean_cost"), r("asd", 6).alias("asd"), "is_best")
