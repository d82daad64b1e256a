"""Checks of scans and sinks: write a stand-in view with our writers below the
checkpoint folder, read it back with our readers, compare with the view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwise import schemas
from tripwise.checks.registry import events, r, register, weather_df
from tripwise.operators import cleaning as cl
from tripwise.operators import joins
from tripwise.session import scratch_path
from tripwise.sources import readers, writers
from tripwise.sources import standins as sv
from tripwise.sources.standin_sql import clean_taxi_sql, with_views
from tripwise.checks.cleaning import CLEAN_BIKE15_SQL, CLEAN_BIKE_SQL

TAXI8 = ["dt", "time", "dur", "lat1", "lon1", "lat2", "lon2", "psg"]
TAXI7 = [c for c in TAXI8 if c != "dur"]
BIKE11 = ["dt", "time", "dur", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"]
BIKE10 = [c for c in BIKE11 if c != "dur"]


@register("scan_weather", with_views(["weather"], "select dt, round(temp, 6) as temp, rain, snow, wspd from weather"))
def q_scan_weather(spark, sf_dir):
    path = writers.write_csv(weather_df(spark, sf_dir), scratch_path(spark, "weather"), header=True)
    w = readers.read_weather(spark, path)
    return w.select("dt", r("temp", 6).alias("temp"), "rain", "snow", "wspd")


def _taxi_text(spark, sf_dir, labelled: bool):
    t = sv.trips(events(spark, sf_dir))
    cols = TAXI8 if labelled else TAXI7
    header = F.lit(sv.TAXI_HEADER)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in cols])
    return t.select(F.when(F.col("trip_id") % 17 == 0, header).otherwise(line).alias("value"))


def _scan_taxi_q(labelled: bool):
    def q(spark, sf_dir):
        path = scratch_path(spark, "taxi")
        _taxi_text(spark, sf_dir, labelled).write.text(path)
        return readers.read_trips(spark, path, "taxi", labelled).select(*(TAXI8 if labelled else TAXI7))
    return q


register("scan_taxi", with_views(["trips"], f"select {', '.join(TAXI8)} from trips where trip_id % 17 <> 0"))(
    _scan_taxi_q(True))
register("scan_taxi_unlabelled", with_views(["trips"], f"select {', '.join(TAXI7)} from trips where trip_id % 17 <> 0"))(
    _scan_taxi_q(False))


def _scan_bike_q(labelled: bool):
    cols = BIKE11 if labelled else BIKE10

    def q(spark, sf_dir):
        t = sv.bike_trips(events(spark, sf_dir), labelled).select(*cols)
        path = writers.write_csv(t, scratch_path(spark, "bike"))
        return readers.read_trips(spark, path, "bike", labelled).select(*cols)
    return q


register("scan_bike", with_views(["trips"], f"select {', '.join(BIKE11)} from trips"))(_scan_bike_q(True))
register("scan_bike_unlabelled", with_views(["trips"], f"select {', '.join(BIKE10)} from trips"))(_scan_bike_q(False))

GREEN_SQL = """select strftime(pickup_ts, '%m/%d/%Y %I:%M:%S %p') as lpep_pickup_datetime,
 strftime(dropoff_ts, '%m/%d/%Y %I:%M:%S %p') as Lpep_dropoff_datetime, pickup_latitude as Pickup_latitude,
 pickup_longitude as Pickup_longitude, dropoff_latitude as Dropoff_latitude, dropoff_longitude as Dropoff_longitude,
 passenger_count as Passenger_count, trip_distance as Trip_distance, event_id from raw_taxi"""


@register("scan_csv_header", with_views(["raw_taxi"], GREEN_SQL.replace(
    "passenger_count as", "case when event_id % 31 <> 0 then passenger_count end as")))
def q_scan_csv_header(spark, sf_dir):
    """Green files with all published columns, read by name; a number that does not parse is NULL."""
    path = writers.write_csv(sv.green_file(events(spark, sf_dir)), scratch_path(spark, "green"), header=True)
    g = readers.read_taxi_csv(spark, path, cl.GREEN, keep=("VendorID",))
    return g.withColumn("event_id", F.col("VendorID").cast("bigint")).drop("VendorID", "malformed")


@register("scan_csv_dropmalformed", with_views(["raw_taxi", "raw_yellow"],
                                               "select * from raw_yellow where event_id % 31 <> 0"))
def q_scan_csv_dropmalformed(spark, sf_dir):
    """Yellow files with all published columns, read by name and by glob; malformed rows ('NA' passengers) dropped."""
    path = writers.write_csv(sv.yellow_file(events(spark, sf_dir)), scratch_path(spark, "yellow"), header=True)
    y = readers.read_taxi_csv(spark, f"{path}/*.csv", cl.YELLOW, keep=("VendorID",)).where(~F.col("malformed"))
    return y.withColumn("event_id", F.col("VendorID").cast("bigint")).drop("VendorID", "malformed")


@register("reject_counts", with_views(["trips"], """select count(*) as lines, count(*) filter (where trip_id % 17 = 0) as headers,
 count(*) filter (where trip_id % 17 <> 0 and trip_id % 13 = 0) as rejected from trips"""))
def q_reject_counts(spark, sf_dir):
    """Lines, header lines and rejected lines of taxi trip files in which every 13th duration is no number."""
    t = sv.trips(events(spark, sf_dir))
    fields = [F.when(F.col("trip_id") % 13 == 0, "x").otherwise(F.col(c).cast("string")) if c == "dur" else F.col(c).cast("string")
              for c in TAXI8]
    path = scratch_path(spark, "rejects")
    t.select(F.when(F.col("trip_id") % 17 == 0, F.lit(sv.TAXI_HEADER)).otherwise(F.concat_ws(",", *fields)).alias("value")) \
        .write.text(path)
    return readers.trip_rejects(spark, path, "taxi")


@register("rejects_by_reason", with_views(["trips"], """select reason, count(*) as lines from (select
 case when trip_id % 17 = 0 then 'header' when trip_id % 11 = 0 then 'dt' when trip_id % 13 = 0 then 'dur'
  when trip_id % 7 = 0 then 'lat1' else 'accepted' end as reason from trips) q group by reason"""))
def q_rejects_by_reason(spark, sf_dir):
    """Why lines of damaged taxi trip files are rejected: the first field that is missing or does not parse."""
    t = sv.trips(events(spark, sf_dir))
    broken = {"dt": (11, "2024-99-01"), "dur": (13, "x"), "lat1": (7, "")}
    fields = [F.when(F.col("trip_id") % broken[c][0] == 0, broken[c][1]).otherwise(F.col(c).cast("string")) if c in broken
              else F.col(c).cast("string") for c in TAXI8]
    path = scratch_path(spark, "damaged")
    t.select(F.when(F.col("trip_id") % 17 == 0, F.lit(sv.TAXI_HEADER)).otherwise(F.concat_ws(",", *fields)).alias("value")) \
        .write.text(path)
    return readers.rejects_by_reason(readers.trip_lines(spark, path, "taxi"))


@register("scan_mixed_headers", with_views(["raw_taxi", "raw_yellow"], "select * from raw_yellow where event_id % 31 <> 0"))
def q_scan_mixed_headers(spark, sf_dir):
    """Yellow files of three layouts under one glob (as published, columns reversed, names in capitals with one more
    column), beside a file that lacks the columns."""
    y = sv.yellow_file(events(spark, sf_dir))
    path = scratch_path(spark, "layouts")
    part = lambda i: y.where(F.col("VendorID").cast("bigint") % 3 == i)
    writers.write_csv(part(0), f"{path}/a", header=True)
    writers.write_csv(part(1).select(*reversed(y.columns)), f"{path}/b", header=True)
    writers.write_csv(part(2).select(F.lit(1).alias("extra"), *[F.col(c).alias(c.upper()) for c in y.columns]), f"{path}/c", header=True)
    writers.write_csv(y.select("VendorID"), f"{path}/d", header=True)
    got = readers.read_taxi_csv(spark, f"{path}/*/*.csv", cl.YELLOW, keep=("VendorID",)).where(~F.col("malformed"))
    return got.withColumn("event_id", F.col("VendorID").cast("bigint")).drop("VendorID", "malformed")


@register("scan_raw_text", with_views(["raw_bike"], "select line from raw_bike"))
def q_scan_raw_text(spark, sf_dir):
    path = scratch_path(spark, "rawbike")
    sv.raw_bike(events(spark, sf_dir)).select(F.col("line").alias("value")).write.text(path)
    return readers.read_lines(spark, path)


@register("scan_zones", with_views(["zones"], "select * from zones"))
def q_scan_zones(spark, sf_dir):
    z = sv.zones(sv.table(spark, sf_dir, "nation"), sv.table(spark, sf_dir, "region"))
    return readers.read_zones(spark, writers.write_csv(z, scratch_path(spark, "zones"), header=True))


@register("zone_enrich", with_views(["trip_locations", "zones"], """select t.trip_id, t.location_id, z.borough, z.zone,
 z.lat, z.lon from trip_locations t left join (select * from zones where borough <> 'Unknown') z
 on t.location_id = z.location_id"""))
def q_zone_enrich(spark, sf_dir):
    ev = events(spark, sf_dir)
    z = sv.zones(sv.table(spark, sf_dir, "nation"), sv.table(spark, sf_dir, "region"))
    return joins.enrich_zones(sv.trip_locations(ev), z).select("trip_id", "location_id", "borough", "zone",
                                                               "lat", "lon")


CLEAN_YELLOW_SQL = clean_taxi_sql(cl.YELLOW.lon_box, cl.YELLOW.lat_box)


@register("sink_csv_roundtrip", with_views(["raw_taxi"], f"select {', '.join(cl.TAXI_OUT)} from ({CLEAN_YELLOW_SQL}) c"))
def q_sink_csv_roundtrip(spark, sf_dir):
    c = cl.clean_taxi(sv.raw_yellow(events(spark, sf_dir)), cl.YELLOW)
    path = writers.write_csv(c, scratch_path(spark, "clean-taxi"))
    return spark.read.schema(schemas.CLEAN_TAXI).csv(path)


@register("sink_text_roundtrip", with_views(["raw_bike"], f"select {', '.join(BIKE11)} from ({CLEAN_BIKE_SQL}) c"))
def q_sink_text_roundtrip(spark, sf_dir):
    c = cl.clean_bike(sv.raw_bike(events(spark, sf_dir)), cl.BIKE_2016)
    path = writers.write_lines(c, scratch_path(spark, "clean-bike"), cl.BIKE_OUT)
    f = F.split(F.col("line"), ",")
    return readers.read_lines(spark, path).select(*[F.get(f, i).alias(n) for i, n in enumerate(cl.BIKE_OUT)])


@register("sink_csv_header", with_views(["raw_bike"], f"select {', '.join(BIKE11)} from ({CLEAN_BIKE_SQL}) c"))
def q_sink_csv_header(spark, sf_dir):
    c = cl.clean_bike(sv.raw_bike(events(spark, sf_dir)), cl.BIKE_2016).select(*cl.BIKE_OUT)
    path = writers.write_csv(c, scratch_path(spark, "clean-bike-h"), header=True)
    return readers.read_csv_header(spark, path, ", ".join(f"{n} string" for n in cl.BIKE_OUT))


@register("preview", with_views(["raw_bike"], f"select * from ({CLEAN_BIKE_SQL}) c order by dt, time, event_id limit 5"))
def q_preview(spark, sf_dir):
    """First five cleaned rows under a total order (a 5-row preview is the feature)."""
    c = cl.clean_bike(sv.raw_bike(events(spark, sf_dir)), cl.BIKE_2016).select("event_id", *cl.BIKE_OUT)
    return c.orderBy("dt", "time", "event_id").limit(5)


@register("clean_bike_job", with_views(["raw_bike"], f"select {', '.join(BIKE11)} from ({CLEAN_BIKE15_SQL}) a "
                                                     f"union all select {', '.join(BIKE11)} from ({CLEAN_BIKE_SQL}) b"))
def q_clean_bike_job(spark, sf_dir):
    """Raw bike text in a 2015 and a 2016 directory -> cleaned comma-joined text, read back."""
    from tripwise.plans.cleaning_jobs import clean_bike_job
    lines = sv.raw_bike(events(spark, sf_dir)).select(F.col("line").alias("value"))
    dirs = {}
    for year in ("2015", "2016"):
        dirs[year] = scratch_path(spark, f"bike-{year}")
        lines.write.text(dirs[year])
    out = clean_bike_job(spark, dirs, scratch_path(spark, "bike-clean"))
    f = F.split(F.col("line"), ",")
    return readers.read_lines(spark, out["path"]).select(*[F.get(f, i).alias(n) for i, n in enumerate(cl.BIKE_OUT)])


@register("clean_taxi_job", with_views(["raw_taxi"], f"""select {', '.join(cl.TAXI_OUT)} from ({CLEAN_YELLOW_SQL}) c
 where event_id % 31 <> 0"""))
def q_clean_taxi_job(spark, sf_dir):
    """Yellow CSV files with headers (some malformed rows) -> cleaned headerless CSV, read back."""
    from tripwise.plans.cleaning_jobs import clean_taxi_job
    src = writers.write_csv(sv.yellow_file(events(spark, sf_dir)), scratch_path(spark, "yellow-job"), header=True)
    out = clean_taxi_job(spark, f"{src}/*.csv", scratch_path(spark, "yellow-clean"))
    return spark.read.schema(schemas.CLEAN_TAXI).csv(out["path"])


CLEAN_GREEN_COLS = ", ".join("case when event_id % 31 <> 0 then passenger_count end as passenger_count" if c == "passenger_count" else c
                             for c in cl.TAXI_OUT)


@register("clean_taxi_job_green", with_views(["raw_taxi"], f"""select {CLEAN_GREEN_COLS}
 from ({clean_taxi_sql(cl.GREEN.lon_box, cl.GREEN.lat_box)}) c"""))
def q_clean_taxi_job_green(spark, sf_dir):
    """Green CSV files with headers, read permissively -> cleaned headerless CSV, read back."""
    from tripwise.plans.cleaning_jobs import clean_taxi_job
    src = writers.write_csv(sv.green_file(events(spark, sf_dir)), scratch_path(spark, "green-job"), header=True)
    out = clean_taxi_job(spark, f"{src}/*.csv", scratch_path(spark, "green-clean"), cl.GREEN)
    return spark.read.schema(schemas.CLEAN_TAXI).csv(out["path"])
