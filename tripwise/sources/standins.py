"""Stand-in trip, weather, raw-file and zone tables derived from the driver tables.

The driver ships no trip, weather or zone data, so these views re-shape
``events`` (one event = one trip), ``nation`` and ``region`` into the inputs
the trip jobs expect.  Every view is a narrow projection or one small
aggregate over the whole table, so its size grows with the driver data.
The same views in DuckDB SQL live in ``standin_sql`` for the oracle checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BIKE_HEADER = ("tripduration,starttime,stoptime,sid,sname,slat,slon,eid,ename,"
               "elat,elon,bikeid,usertype,birth year,gender")
TAXI_HEADER = "date,time,duration,lat1,lon1,lat2,lon2,psg"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _c(name: str) -> Column:
    return F.col(name)


def _coord(base: float, mult: int, mod: int, extra: Column | None = None) -> Column:
    key = _c("user_id") * F.lit(mult)
    if extra is not None:
        key = key + extra
    return F.lit(base) + (key % F.lit(mod)) / F.lit(1000.0)


def start_lat(mod: int = 400, base: float = 40.5) -> Column:
    return _coord(base, 37, mod)


def start_lon(mod: int = 450, base: float = -74.2) -> Column:
    return _coord(base, 53, mod)


def end_lat(mod: int = 400, base: float = 40.5) -> Column:
    return _coord(base, 37, mod, _c("event_id") * F.lit(29))


def end_lon(mod: int = 450, base: float = -74.2) -> Column:
    return _coord(base, 53, mod, _c("event_id") * F.lit(31))


def _hms(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def trips(events: DataFrame) -> DataFrame:
    """Labelled trips: bike and taxi columns together, one per event."""
    ts = _c("ts")
    return events.select(
        _c("event_id").alias("trip_id"),
        _c("user_id"),
        ts.cast("date").alias("dt"),
        _hms(ts).alias("time"),
        F.floor(_c("value") * F.lit(20)).cast("double").alias("dur"),
        start_lat().alias("lat1"), start_lon().alias("lon1"),
        end_lat().alias("lat2"), end_lon().alias("lon2"),
        (F.lit(1) + _c("event_id") % F.lit(5)).cast("double").alias("psg"),
        _c("user_id").cast("double").alias("id1"),
        (_c("event_id") % F.lit(150)).cast("double").alias("id2"),
        (F.lit(1930) + _c("user_id") % F.lit(80)).cast("double").alias("yr"),
        (_c("event_id") % F.lit(3)).cast("double").alias("gdr"),
    )


TAXI_COLS = ["trip_id", "dt", "time", "dur", "lat1", "lon1", "lat2", "lon2", "psg"]
BIKE_COLS = ["trip_id", "dt", "time", "dur", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"]


def taxi_trips(events: DataFrame, labelled: bool = True) -> DataFrame:
    cols = TAXI_COLS if labelled else [c for c in TAXI_COLS if c != "dur"]
    return trips(events).select(*cols)


def bike_trips(events: DataFrame, labelled: bool = True) -> DataFrame:
    cols = BIKE_COLS if labelled else [c for c in BIKE_COLS if c != "dur"]
    return trips(events).select(*cols)


def weather(events: DataFrame) -> DataFrame:
    """One row per day; days 10, 20 and 30 are absent so the inner join drops trips."""
    day = _c("ts").cast("date")
    return (events.where(F.dayofmonth(_c("ts")) % 10 != 0)
            .groupBy(day.alias("dt"))
            .agg(F.avg("value").alias("temp"),
                 (F.sum(F.when(_c("event_type") == "error", 1).otherwise(0)) / F.lit(100.0)).alias("rain"),
                 F.min("value").alias("snow"),
                 (F.max("value") / F.lit(50.0)).alias("wspd")))


def raw_bike(events: DataFrame) -> DataFrame:
    """One dirty 15-field text line per event (headers, missing fields, quotes,
    blank or non-numeric birth years, two date styles, times without seconds)."""
    eid, ts, uid = _c("event_id"), _c("ts"), _c("user_id")
    date_txt = F.when(eid % 3 == 0, ts.cast("date").cast("string")).otherwise(
        F.concat_ws("/", F.month(ts).cast("string"), F.dayofmonth(ts).cast("string"),
                    F.year(ts).cast("string")))
    time_txt = F.concat(F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lit(":"),
                        F.lpad(F.minute(ts).cast("string"), 2, "0"),
                        F.when(eid % 5 == 0, F.lit("")).otherwise(
                            F.concat(F.lit(":"), F.lpad(F.second(ts).cast("string"), 2, "0"))))
    byear = (F.when(eid % 11 == 0, F.lit("")).when(eid % 19 == 0, F.lit("NULL"))
             .otherwise((F.lit(1890) + uid % F.lit(130)).cast("string")))

    def dec3(c: Column) -> Column:
        return c.cast("decimal(9,3)").cast("string")

    line = F.concat(
        F.floor(_c("value") * F.lit(20)).cast("int").cast("string"), F.lit(","),
        date_txt, F.lit(" "), time_txt, F.lit(",stop,"),
        uid.cast("string"), F.lit(",start st,"),
        dec3(start_lat()), F.lit(","), dec3(start_lon()), F.lit(","),
        (eid % F.lit(150)).cast("string"), F.lit(",end st,"),
        dec3(end_lat()), F.lit(","), dec3(end_lon()), F.lit(","),
        eid.cast("string"), F.lit(",Customer,"), byear, F.lit(","),
        (eid % F.lit(3)).cast("string"))
    dirty = (F.when(eid % 17 == 0, F.lit(BIKE_HEADER))
             .when(eid % 13 == 0, F.replace(line, F.lit(",Customer"), F.lit("")))
             .when(eid % 7 == 0, F.concat(F.lit('"'), F.replace(line, F.lit(","), F.lit('","')), F.lit('"')))
             .otherwise(line))
    return events.select(eid.alias("event_id"), dirty.alias("line"))


def raw_taxi(events: DataFrame) -> DataFrame:
    """Raw taxi records: timestamps, coordinates partly outside the city box,
    a NULL pickup latitude on some rows, and the trip distance."""
    eid = _c("event_id")
    box = dict(mod=2300)
    return events.select(
        eid.alias("event_id"),
        _c("ts").alias("pickup_ts"),
        (_c("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                       F.floor(_c("value") * F.lit(20)).cast("int"))).alias("dropoff_ts"),
        F.when(eid % 23 == 0, F.lit(None).cast("double"))
         .otherwise(start_lat(base=39.4, **box)).alias("pickup_latitude"),
        start_lon(base=-75.1, **box).alias("pickup_longitude"),
        end_lat(base=39.4, **box).alias("dropoff_latitude"),
        end_lon(base=-75.1, **box).alias("dropoff_longitude"),
        (F.lit(1) + eid % F.lit(5)).alias("passenger_count"),
        (_c("value") / F.lit(10.0)).alias("trip_distance"),
    )


def taxi_lines(events: DataFrame) -> DataFrame:
    """Cleaned-taxi text lines (date first), with a header line on some rows."""
    t = trips(events)
    line = F.concat_ws(",", _c("dt").cast("string"), _c("time"), _c("dur").cast("string"),
                       _c("lat1").cast("string"), _c("lon1").cast("string"),
                       _c("lat2").cast("string"), _c("lon2").cast("string"), _c("psg").cast("string"))
    return t.select(_c("trip_id"),
                    F.when(_c("trip_id") % 17 == 0, F.lit(TAXI_HEADER)).otherwise(line).alias("line"))


def zones(nation: DataFrame, region: DataFrame, with_unknown: bool = True) -> DataFrame:
    """Zone lookup: id, borough, zone name and a coordinate per zone."""
    z = (nation.join(region, nation.n_regionkey == region.r_regionkey)
         .select((_c("n_nationkey") + F.lit(1)).alias("location_id"),
                 _c("r_name").alias("borough"), _c("n_name").alias("zone"),
                 (F.lit(40.5) + _c("n_nationkey") / F.lit(100.0)).alias("lat"),
                 (F.lit(-74.2) + _c("n_nationkey") / F.lit(100.0)).alias("lon")))
    if with_unknown:
        # The real lookup ends with an "Unknown" borough whose coordinate lies out of town.
        extra = (nation.agg((F.max("n_nationkey") + F.lit(2)).alias("location_id"))
                 .select("location_id", F.lit("Unknown").alias("borough"), F.lit("Unknown").alias("zone"),
                         F.lit(38.876392).alias("lat"), F.lit(-77.0721696).alias("lon")))
        z = z.unionByName(extra)
    return z


def trip_locations(events: DataFrame, n_locations: int = 30) -> DataFrame:
    """Trips tagged with a pickup location id (some ids have no zone)."""
    return events.select(_c("event_id").alias("trip_id"),
                         (F.lit(1) + _c("event_id") % F.lit(n_locations)).alias("location_id"))


def fixed_centres(n: int = 12) -> list[tuple[float, float]]:
    """Deterministic end-point centres (lat, lon): k-th = (40.55 + 0.04 k, -74.15 + 0.05 k)."""
    return [(round(40.55 + 0.04 * k, 2), round(-74.15 + 0.05 * k, 2)) for k in range(n)]


def raw_yellow(events: DataFrame) -> DataFrame:
    """Yellow-taxi style records: text timestamps ``yyyy-MM-dd HH:mm:ss``."""
    t = raw_taxi(events)
    return t.select("event_id",
                    F.date_format("pickup_ts", "yyyy-MM-dd HH:mm:ss").alias("tpep_pickup_datetime"),
                    F.date_format("dropoff_ts", "yyyy-MM-dd HH:mm:ss").alias("tpep_dropoff_datetime"),
                    "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
                    "passenger_count", "trip_distance")


def raw_green(events: DataFrame) -> DataFrame:
    """Green-taxi style records: 12-hour text timestamps and capitalised names."""
    t = raw_taxi(events)
    fmt = "MM/dd/yyyy hh:mm:ss a"
    return t.select("event_id",
                    F.date_format("pickup_ts", fmt).alias("lpep_pickup_datetime"),
                    F.date_format("dropoff_ts", fmt).alias("Lpep_dropoff_datetime"),
                    F.col("pickup_latitude").alias("Pickup_latitude"),
                    F.col("pickup_longitude").alias("Pickup_longitude"),
                    F.col("dropoff_latitude").alias("Dropoff_latitude"),
                    F.col("dropoff_longitude").alias("Dropoff_longitude"),
                    F.col("passenger_count").alias("Passenger_count"),
                    F.col("trip_distance").alias("Trip_distance"))


# The columns of the published yellow and green files, in their order.
YELLOW_FILE = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
               "pickup_longitude", "pickup_latitude", "RatecodeID", "store_and_fwd_flag", "dropoff_longitude",
               "dropoff_latitude", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
               "improvement_surcharge", "total_amount"]
GREEN_FILE = ["VendorID", "lpep_pickup_datetime", "Lpep_dropoff_datetime", "Store_and_fwd_flag", "RateCodeID",
              "Pickup_longitude", "Pickup_latitude", "Dropoff_longitude", "Dropoff_latitude", "Passenger_count",
              "Trip_distance", "Fare_amount", "Extra", "MTA_tax", "Tip_amount", "Tolls_amount", "Ehail_fee",
              "improvement_surcharge", "Total_amount", "Payment_type", "Trip_type "]


def taxi_file(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a published taxi file: the event id as vendor, no passenger number on every 31st row, filler elsewhere."""
    held = {c.lower(): c for c in raw.columns}
    cols = []
    for c in columns:
        name = held.get(c.lower())
        col = F.col(name).cast("string") if name else F.col("event_id").cast("string") if c == "VendorID" else F.lit("1")
        cols.append((F.when(F.col("event_id") % 31 == 0, "NA").otherwise(col) if c.lower() == "passenger_count" else col).alias(c))
    return raw.select(*cols)


def yellow_file(events: DataFrame) -> DataFrame:
    return taxi_file(raw_yellow(events), YELLOW_FILE)


def green_file(events: DataFrame) -> DataFrame:
    return taxi_file(raw_green(events), GREEN_FILE)
