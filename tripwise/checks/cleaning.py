"""Checks of the cleaning operators over the raw bike and taxi stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwise.checks.registry import events, register
from tripwise.operators import cleaning as cl
from tripwise.operators.outliers import duration_open
from tripwise.sources import standins as sv
from tripwise.sources.standin_sql import BOUNDS_SQL, SHAPE_SQL, bike_fields_sql, clean_taxi_sql, with_views

BIKE_VIEWS = ["raw_bike"]
FIELDS16 = bike_fields_sql(cl.BIKE_2016.header_prefixes, True)
FIELDS15 = bike_fields_sql(cl.BIKE_2015.header_prefixes, False)
OUT = ", ".join(cl.BIKE_OUT)


def raw(spark, sf_dir):
    return sv.raw_bike(events(spark, sf_dir))


def split_sql(where: str = "") -> str:
    return f"select event_id, string_split(rtrim(line, ','), ',') as f from raw_bike {where}"


@register("parse_line", with_views(BIKE_VIEWS, f"select event_id, cast(len(f) as integer) as n_fields, try_cast(f[1] as int) as dur "
                                               f"from ({split_sql()}) s"))
def q_parse_line(spark, sf_dir):
    d = raw(spark, sf_dir).withColumn("f", cl.split_line(F.col("line")))
    return d.select("event_id", F.size("f").alias("n_fields"), F.get("f", 0).try_cast("int").alias("dur"))


TAXI_LINE_SQL = ("select trip_id, case when trip_id%17=0 then 'x' else cast(dt as varchar) || ',' || time end as line "
                 "from trips")


@register("drop_header_prefix", with_views(["trips"], f"select trip_id from ({TAXI_LINE_SQL}) l "
                                                      "where starts_with(line, '2')"))
def q_drop_header_prefix(spark, sf_dir):
    lines = sv.taxi_lines(events(spark, sf_dir))
    return cl.drop_header_prefix(lines, "line").select("trip_id")


@register("reject_malformed", with_views(BIKE_VIEWS, f"""select event_id from ({split_sql(
    "where not starts_with(line, 'Trip') and not starts_with(line, '\"trip')")}) s
 where len(f) = 15 and contains(f[2], ' ') and not list_contains(f, '')"""))
def q_reject_malformed(spark, sf_dir):
    d = cl.drop_headers(raw(spark, sf_dir), "line", cl.BIKE_2016.header_prefixes)
    d = d.withColumn("f", cl.split_line(F.col("line")))
    return cl.reject_malformed(d).select("event_id")


@register("f_unquote", with_views(BIKE_VIEWS, f"""select event_id, array_to_string(list_transform(f,
 lambda x: regexp_replace(regexp_replace(x, '^"', ''), '"$', '')), '|') as fields from ({split_sql()}) s"""))
def q_f_unquote(spark, sf_dir):
    d = raw(spark, sf_dir).withColumn("f", cl.split_line(F.col("line")))
    return d.select("event_id", F.concat_ws("|", F.transform("f", cl.unquote)).alias("fields"))


@register("f_normalise_date", with_views(BIKE_VIEWS, f"""select a.event_id, a.dt as dt_iso_kept, b.dt as dt_strict
 from ({FIELDS16}) a join ({bike_fields_sql(cl.BIKE_2016.header_prefixes, False)}) b on a.event_id = b.event_id"""))
def q_f_normalise_date(spark, sf_dir):
    """Dates under both rules, joined on event_id as in the SQL: a repeated key pairs all its rows, a null key none."""
    rb = raw(spark, sf_dir)
    strict = cl.BikeProfile(cl.BIKE_2016.header_prefixes, keep_iso_dates=False)
    kept = cl.bike_fields(rb, cl.BIKE_2016).select("event_id", F.col("dt").alias("dt_iso_kept"))
    return kept.join(cl.bike_fields(rb, strict).select("event_id", F.col("dt").alias("dt_strict")), "event_id")


@register("f_normalise_time", with_views(BIKE_VIEWS, f"select event_id, time from ({FIELDS16}) f"))
def q_f_normalise_time(spark, sf_dir):
    return cl.bike_fields(raw(spark, sf_dir), cl.BIKE_2016).select("event_id", "time")


@register("validate_regex", with_views(BIKE_VIEWS, f"select event_id, {OUT} from ({FIELDS16}) f where {SHAPE_SQL}"))
def q_validate_regex(spark, sf_dir):
    return cl.validate_regex(cl.bike_fields(raw(spark, sf_dir), cl.BIKE_2016)).select("event_id", *cl.BIKE_OUT)


@register("bike_bounds", with_views(BIKE_VIEWS, f"select event_id from ({FIELDS16}) f where {BOUNDS_SQL}"))
def q_bike_bounds(spark, sf_dir):
    return cl.bike_bounds(cl.bike_fields(raw(spark, sf_dir), cl.BIKE_2016)).select("event_id")


CLEAN_BIKE_SQL = f"select event_id, {OUT} from ({FIELDS16}) f where {SHAPE_SQL} and {BOUNDS_SQL}"
CLEAN_BIKE15_SQL = f"select event_id, {OUT} from ({FIELDS15}) f where {SHAPE_SQL} and {BOUNDS_SQL}"


@register("clean_bike", with_views(BIKE_VIEWS, CLEAN_BIKE_SQL))
def q_clean_bike(spark, sf_dir):
    return cl.clean_bike(raw(spark, sf_dir), cl.BIKE_2016).select("event_id", *cl.BIKE_OUT)


@register("union_years", with_views(BIKE_VIEWS, f"{CLEAN_BIKE15_SQL} union all {CLEAN_BIKE_SQL}"))
def q_union_years(spark, sf_dir):
    """The same raw lines cleaned under the 2015 and the 2016 rules, unioned."""
    rb = raw(spark, sf_dir)
    u = cl.clean_bike_years({"2015": rb, "2016": rb}, {"2015": cl.BIKE_2015, "2016": cl.BIKE_2016})
    return u.select("event_id", *cl.BIKE_OUT)


@register("cleaning_counts_bike", with_views(BIKE_VIEWS, f"""select count(*) as well_formed,
 count(*) filter (where {SHAPE_SQL}) as valid_shape,
 count(*) filter (where {SHAPE_SQL} and {BOUNDS_SQL}) as in_bounds from ({FIELDS16}) f"""))
def q_cleaning_counts_bike(spark, sf_dir):
    return cl.bike_counts(raw(spark, sf_dir), cl.BIKE_2016)


# ------------------------------------------------------------------- taxi
TAXI_VIEWS = ["raw_taxi"]
PROJ = clean_taxi_sql(cl.YELLOW.lon_box, cl.YELLOW.lat_box, final=False)


def yellow(spark, sf_dir):
    return sv.raw_yellow(events(spark, sf_dir))


def green(spark, sf_dir):
    return sv.raw_green(events(spark, sf_dir))


@register("trip_duration", with_views(TAXI_VIEWS, f"select event_id, Duration from ({PROJ}) p"))
def q_trip_duration(spark, sf_dir):
    return yellow(spark, sf_dir).select("event_id", cl.trip_duration(cl.YELLOW).alias("Duration"))


@register("split_timestamp", with_views(TAXI_VIEWS, f"select event_id, pck_date, pck_hms from ({PROJ}) p"))
def q_split_timestamp(spark, sf_dir):
    return cl.project_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",)) \
             .select("event_id", "pck_date", "pck_hms")


@register("project_taxi", with_views(TAXI_VIEWS, PROJ))
def q_project_taxi(spark, sf_dir):
    return cl.project_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",))


@register("duration_open", with_views(TAXI_VIEWS, f"select event_id, Duration from ({PROJ}) p "
                                                  "where Duration > 120 and Duration < 3600"))
def q_duration_open(spark, sf_dir):
    p = cl.project_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",))
    return duration_open(p, "Duration").select("event_id", "Duration")


@register("coords_not_null", with_views(TAXI_VIEWS, f"""select event_id from ({PROJ}) p where pickup_latitude is not null
 and pickup_longitude is not null and dropoff_latitude is not null and dropoff_longitude is not null"""))
def q_coords_not_null(spark, sf_dir):
    p = cl.project_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",))
    return cl.coords_not_null(p).select("event_id")


@register("coords_nonzero", with_views(TAXI_VIEWS, f"""select event_id from ({PROJ}) p where pickup_latitude <> 0
 and pickup_longitude <> 0 and dropoff_latitude <> 0 and dropoff_longitude <> 0"""))
def q_coords_nonzero(spark, sf_dir):
    p = cl.project_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",))
    return cl.coords_nonzero(p).select("event_id")


def _box_sql(spec) -> str:
    (lo_lon, hi_lon), (lo_lat, hi_lat) = spec.lon_box, spec.lat_box
    return (f"select event_id from ({PROJ}) p where pickup_longitude < {hi_lon} and pickup_longitude > {lo_lon} "
            f"and dropoff_longitude < {hi_lon} and dropoff_longitude > {lo_lon} and pickup_latitude < {hi_lat} "
            f"and pickup_latitude > {lo_lat} and dropoff_latitude < {hi_lat} and dropoff_latitude > {lo_lat}")


@register("bbox_yellow", with_views(TAXI_VIEWS, _box_sql(cl.YELLOW)))
def q_bbox_yellow(spark, sf_dir):
    p = cl.project_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",))
    return cl.bounding_box(p, cl.YELLOW).select("event_id")


@register("bbox_green", with_views(TAXI_VIEWS, _box_sql(cl.GREEN)))
def q_bbox_green(spark, sf_dir):
    p = cl.project_taxi(green(spark, sf_dir), cl.GREEN, keep=("event_id",))
    return cl.bounding_box(p, cl.GREEN).select("event_id")


@register("clean_taxi_yellow", with_views(TAXI_VIEWS, clean_taxi_sql(cl.YELLOW.lon_box, cl.YELLOW.lat_box)))
def q_clean_taxi_yellow(spark, sf_dir):
    return cl.clean_taxi(yellow(spark, sf_dir), cl.YELLOW, keep=("event_id",))


@register("clean_taxi_green", with_views(TAXI_VIEWS, clean_taxi_sql(cl.GREEN.lon_box, cl.GREEN.lat_box)))
def q_clean_taxi_green(spark, sf_dir):
    return cl.clean_taxi(green(spark, sf_dir), cl.GREEN, keep=("event_id",))


@register("cleaning_counts", with_views(TAXI_VIEWS, f"""select count(*) as total,
 count(*) filter (where pickup_latitude is not null and pickup_longitude is not null and dropoff_latitude is not null
  and dropoff_longitude is not null) as non_null,
 count(*) filter (where event_id in ({clean_taxi_sql(cl.YELLOW.lon_box, cl.YELLOW.lat_box).replace('select *', 'select event_id', 1)})) as in_box
 from ({PROJ}) p where Duration > 120 and Duration < 3600"""))
def q_cleaning_counts(spark, sf_dir):
    return cl.cleaning_counts(yellow(spark, sf_dir), cl.YELLOW)
