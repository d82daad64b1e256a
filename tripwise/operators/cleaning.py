"""Cleaning of raw trip records.

Bike: dirty comma-separated text lines -> header drop -> shape checks ->
unquote -> date / time normalisation -> regex validation -> bounds.
Taxi: raw records with text timestamps -> duration -> date / time split ->
open duration bounds -> non-null coordinates -> bounding box.

Everything is a narrow projection or filter (no shuffle); counts per step are
one aggregate pass.  Where the source would throw on a malformed value the
value becomes NULL (``try_*``) and the row is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.functions.text import normalise_date, normalise_time
from tripwise.operators.outliers import duration_open

BIKE_ARITY = 15
# Positions in a raw bike line: duration, start time, start id, start lat, start lon,
# end id, end lat, end lon, birth year, gender.
BIKE_PICK = {"dur": 0, "id1": 3, "lat1": 5, "lon1": 6, "id2": 7, "lat2": 9, "lon2": 10, "yr": 13, "gdr": 14}
BIKE_OUT = ["dt", "time", "dur", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"]

# Full-match shape of each picked field ('.' is any character, as in the source).
INT_RE = r"\d+"
LAT_RE = r"\d{2}.\d+"
LON_RE = r"-\d{2}.\d+"
BIKE_SHAPES = {"dur": INT_RE, "id1": INT_RE, "lat1": LAT_RE, "lon1": LON_RE, "id2": INT_RE,
               "lat2": LAT_RE, "lon2": LON_RE, "yr": INT_RE, "gdr": INT_RE}

# City box and birth-year range of the bike data, all bounds inclusive.
BIKE_LAT = (40.4774, 40.9176)
BIKE_LON = (-74.2589, -73.7004)
BIKE_YEARS = (1900, 2010)
BIKE_DURATION = (120, 3600)


@dataclass(frozen=True)
class BikeProfile:
    """Per-year differences: header prefixes and whether ISO dates pass through."""
    header_prefixes: tuple[str, ...]
    keep_iso_dates: bool


# 2015 files start headers with 'trip' or '"trip' and always use
# M/d/yyyy; 2016 files start them with 'Trip' or '"trip' and mix in ISO dates.
BIKE_2015 = BikeProfile(("trip", '"trip'), keep_iso_dates=False)
BIKE_2016 = BikeProfile(("Trip", '"trip'), keep_iso_dates=True)


def split_line(line: Column, sep: str = ",") -> Column:
    """Split like Java's String.split: trailing empty fields are removed."""
    return F.split(F.regexp_replace(line, f"{sep}+$", ""), sep)


def drop_header_prefix(df: DataFrame, col: str, prefix: str = "2") -> DataFrame:
    """Keep rows whose text starts with ``prefix`` (data rows begin with a year)."""
    return df.where(F.col(col).startswith(prefix))


def not_header(line: Column, prefixes: tuple[str, ...]) -> Column:
    cond = None
    for p in prefixes:
        c = ~line.startswith(p)
        cond = c if cond is None else cond & c
    return cond


def drop_headers(df: DataFrame, line: str, prefixes: tuple[str, ...]) -> DataFrame:
    return df.where(not_header(F.col(line), prefixes))


def reject_malformed(df: DataFrame, fields: str = "f", arity: int = BIKE_ARITY) -> DataFrame:
    """Keep rows whose split fields are well formed (see ``well_formed``)."""
    return df.where(well_formed(F.col(fields), arity))


def unquote(field: Column) -> Column:
    """One leading, then one trailing double quote removed (one regex pass:
    for a lone '"' both forms give the empty string).  Fields without a quote,
    the common case, skip the regex."""
    return F.when(field.contains('"'), F.regexp_replace(field, r'^"|"$', "")).otherwise(field)


def well_formed(f: Column, arity: int = BIKE_ARITY) -> Column:
    """Arity, a space in the start time, no empty field (checked before unquoting)."""
    return (F.size(f) == arity) & F.get(f, 1).contains(" ") & ~F.array_contains(f, "")


def bike_fields(df: DataFrame, profile: BikeProfile, line: str = "line") -> DataFrame:
    """Header drop, split, shape check, unquote, pick and normalise: string columns.

    Each line is split once and each record parsed once: the parsed record
    comes out of a generator (a 0- or 1-element array), and filters above a
    generator are not pushed back into it, so later predicates read the
    parsed fields instead of re-parsing the line.  Only the picked fields are
    unquoted (per field, which equals unquoting the whole array first).
    """
    keep = [c for c in df.columns if c != line]
    # Header test, split and parse all feed the generator; nothing filters the
    # raw line first, so a computed line is never re-derived inside a filter.
    d = df.select(*keep, F.col(line).alias("_line"), split_line(F.col(line)).alias("f"))
    f = F.col("f")
    d = d.select(*keep, "_line", "f", F.split(unquote(F.get(f, 1)), " ").alias("start"))
    start = F.col("start")
    rec = F.struct(normalise_date(F.get(start, 0), profile.keep_iso_dates).alias("dt"),
                   normalise_time(F.get(start, 1)).alias("time"),
                   *[unquote(F.get(f, i)).alias(n) for n, i in BIKE_PICK.items()])
    ok = not_header(F.col("_line"), profile.header_prefixes) & well_formed(f)
    one = F.when(ok, F.array(rec))      # NULL for a header or malformed line: explode emits nothing
    return d.select(*keep, F.explode(one).alias("r")).select(*keep, "r.*")


def _between(c: Column, lo, hi) -> Column:
    return (c >= F.lit(lo)) & (c <= F.lit(hi))


def shape_ok() -> Column:
    """Date and time parsed, every picked field fully matching its shape."""
    cond = F.col("dt").isNotNull() & F.col("time").isNotNull()
    for name, pattern in BIKE_SHAPES.items():
        cond = cond & F.col(name).rlike(f"^(?:{pattern})$")
    return cond


def bounds_ok() -> Column:
    """Duration, coordinates and birth year inside their inclusive ranges."""
    dur, yr = F.col("dur").try_cast("int"), F.col("yr").try_cast("int")
    cond = _between(dur, *BIKE_DURATION) & _between(yr, *BIKE_YEARS)
    for lat, lon in (("lat1", "lon1"), ("lat2", "lon2")):
        cond = cond & _between(F.col(lat).try_cast("double"), *BIKE_LAT) \
                    & _between(F.col(lon).try_cast("double"), *BIKE_LON)
    return cond


def validate_regex(df: DataFrame) -> DataFrame:
    return df.where(shape_ok())


def bike_bounds(df: DataFrame) -> DataFrame:
    return df.where(bounds_ok())


def clean_bike(raw: DataFrame, profile: BikeProfile = BIKE_2016, line: str = "line") -> DataFrame:
    """Raw text lines -> the 11 cleaned string fields (plus any id columns of ``raw``)."""
    return bike_bounds(validate_regex(bike_fields(raw, profile, line)))


def clean_bike_years(raws: dict[str, DataFrame], profiles: dict[str, BikeProfile], year_col: str = "_year") -> DataFrame:
    """Clean each year with its own profile and union them by name; ``year_col`` tells the year."""
    out = None
    for year, raw in raws.items():
        c = clean_bike(raw, profiles[year]).withColumn(year_col, F.lit(year))
        out = c if out is None else out.unionByName(c)
    return out


def bike_counts(raw: DataFrame, profile: BikeProfile = BIKE_2016, line: str = "line") -> DataFrame:
    """Rows surviving each bike step, in one pass."""
    f = bike_fields(raw, profile, line)
    return f.agg(F.count(F.lit(1)).alias("well_formed"),
                 F.count_if(shape_ok()).alias("valid_shape"),
                 F.count_if(shape_ok() & bounds_ok()).alias("in_bounds"))


# ------------------------------------------------------------------- taxi
@dataclass(frozen=True)
class TaxiSpec:
    """Column names, timestamp pattern and city box of one taxi source."""
    pickup: str
    dropoff: str
    pickup_lat: str
    pickup_lon: str
    dropoff_lat: str
    dropoff_lon: str
    passengers: str
    distance: str
    ts_pattern: str
    lon_box: tuple[float, float]
    lat_box: tuple[float, float]
    drop_malformed: bool = False

    @property
    def numbers(self) -> dict[str, str]:
        """The number columns and their types."""
        coords = (self.pickup_lat, self.pickup_lon, self.dropoff_lat, self.dropoff_lon)
        return {c: "double" for c in coords} | {self.passengers: "bigint", self.distance: "double"}


# Yellow and green source columns, patterns and open city boxes.
# (The 12-hour pattern of the green files is written with 'hh' and one 'a'.)
YELLOW = TaxiSpec("tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_latitude", "pickup_longitude",
                  "dropoff_latitude", "dropoff_longitude", "passenger_count", "trip_distance",
                  "yyyy-MM-dd HH:mm:ss", (-75.0, -73.0), (39.5, 41.5), True)
GREEN = TaxiSpec("lpep_pickup_datetime", "Lpep_dropoff_datetime", "Pickup_latitude", "Pickup_longitude",
                 "Dropoff_latitude", "Dropoff_longitude", "Passenger_count", "Trip_distance",
                 "MM/dd/yyyy hh:mm:ss a", (-75.0, -72.0), (39.5, 42.0))

TAXI_OUT = ["pck_date", "pck_hms", "Duration", "pickup_latitude", "pickup_longitude",
            "dropoff_latitude", "dropoff_longitude", "passenger_count", "trip_distance"]


def _epoch(c: Column, pattern: str) -> Column:
    """Seconds since the epoch; NULL where the text is no timestamp (also under ANSI mode)."""
    return F.unix_timestamp(F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c))


def trip_duration(spec: TaxiSpec = YELLOW) -> Column:
    """Dropoff - pickup in seconds (text parsed with the source pattern)."""
    return _epoch(F.col(spec.dropoff), spec.ts_pattern) - _epoch(F.col(spec.pickup), spec.ts_pattern)


def project_taxi(df: DataFrame, spec: TaxiSpec = YELLOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pick and rename: pickup date and time of day, duration, coordinates,
    passengers and distance (under the yellow names)."""
    pck = _epoch(F.col(spec.pickup), spec.ts_pattern)
    return df.select(*keep,
                     F.from_unixtime(pck, "yyyy-MM-dd").alias("pck_date"),
                     F.from_unixtime(pck, "HH:mm:ss").alias("pck_hms"),
                     trip_duration(spec).alias("Duration"),
                     F.col(spec.pickup_lat).alias("pickup_latitude"),
                     F.col(spec.pickup_lon).alias("pickup_longitude"),
                     F.col(spec.dropoff_lat).alias("dropoff_latitude"),
                     F.col(spec.dropoff_lon).alias("dropoff_longitude"),
                     F.col(spec.passengers).alias("passenger_count"),
                     F.col(spec.distance).alias("trip_distance"))


COORDS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]


def coords_not_null(df: DataFrame) -> DataFrame:
    return df.dropna(subset=COORDS)


def coords_nonzero(df: DataFrame) -> DataFrame:
    """No coordinate equal to 0 (an optional step, off in the source's jobs)."""
    cond = None
    for c in COORDS:
        k = F.col(c) != F.lit(0.0)
        cond = k if cond is None else cond & k
    return df.where(cond)


def _in_box(lon_box, lat_box) -> Column:
    cond = None
    for c in ("pickup_longitude", "dropoff_longitude"):
        k = (F.col(c) < F.lit(lon_box[1])) & (F.col(c) > F.lit(lon_box[0]))
        cond = k if cond is None else cond & k
    for c in ("pickup_latitude", "dropoff_latitude"):
        cond = cond & (F.col(c) < F.lit(lat_box[1])) & (F.col(c) > F.lit(lat_box[0]))
    return cond


def bounding_box(df: DataFrame, spec: TaxiSpec = YELLOW) -> DataFrame:
    """Open box on both ends for pickup and dropoff."""
    return df.where(_in_box(spec.lon_box, spec.lat_box))


def clean_taxi(raw: DataFrame, spec: TaxiSpec = YELLOW, keep: tuple[str, ...] = ()) -> DataFrame:
    p = duration_open(project_taxi(raw, spec, keep))
    return bounding_box(coords_not_null(p), spec)


def step_count_exprs(spec: TaxiSpec = YELLOW) -> list[Column]:
    """Rows after the duration bound, after the non-null step, after the box
    (to be evaluated over rows that passed the duration bound)."""
    nn = None
    for c in COORDS:
        k = F.col(c).isNotNull()
        nn = k if nn is None else nn & k
    return [F.count(F.lit(1)).alias("total"), F.count_if(nn).alias("non_null"),
            F.count_if(nn & _in_box(spec.lon_box, spec.lat_box)).alias("in_box")]


def cleaning_counts(raw: DataFrame, spec: TaxiSpec = YELLOW) -> DataFrame:
    """The three step counts of the taxi job (after duration, non-null, box) in one pass."""
    return duration_open(project_taxi(raw, spec)).agg(*step_count_exprs(spec))
