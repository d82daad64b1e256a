"""Scans: weather and trip CSV files, raw text, header CSV, zone lookup.

All readers take an explicit schema (no inference pass over the data) so the
scan is a single pass with column pruning.  Header lines are removed the way
the sources mark them: taxi and weather data rows start with a year ('2').
"""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise import schemas
from tripwise.operators.cleaning import TaxiSpec


def _paths(path):
    return path if isinstance(path, (list, tuple)) else [path]


def _parsed(raw: DataFrame, reason: Column, columns: list[Column]) -> DataFrame:
    """``columns``, the line as it was read (``raw``) and why it is rejected (``reject``, null for a good line)."""
    return raw.withColumn("reject", reason).select(*columns, "reject", F.to_json(F.struct(*raw.columns)).alias("raw"))


def weather_lines(spark: SparkSession, path) -> DataFrame:
    """Every line of the weather files with ``reject`` and ``raw``: no line is lost in reading."""
    df = spark.read.schema(schemas.WEATHER).csv(_paths(path))
    date = F.try_to_date("dt", "yyyy-MM-dd")
    reason = F.when(~F.coalesce(F.col("dt"), F.lit("")).startswith("2"), "header").when(date.isNull(), "date")
    for c in ("temp", "rain", "snow", "wspd"):
        reason = reason.when(F.col(c).isNull(), c)
    return _parsed(df, reason, [date.alias("dt"), "temp", "rain", "snow", "wspd"])


def read_weather(spark: SparkSession, path) -> DataFrame:
    """Daily weather: lines that begin with a year ('2') and whose date parses (``weather_lines`` tells the others)."""
    return weather_lines(spark, path).where("reject is null or reject not in ('header', 'date')").drop("reject", "raw")


def trip_lines(spark: SparkSession, path, dataset: str, labelled: bool = True) -> DataFrame:
    """Every line of the trip files with ``reject`` and ``raw``: the first field that is missing or does not parse."""
    return parse_trips(spark.read.schema(schemas.trips_schema(dataset, labelled)).csv(_paths(path)), dataset)


def parse_trips(df: DataFrame, dataset: str) -> DataFrame:
    """Parsed lines with the reason of a rejected one; taxi lines that do not begin with a year ('2') are headers,
    bike files have none."""
    date = F.try_to_date("dt", "yyyy-MM-dd")
    head = ~F.coalesce(F.col("dt"), F.lit("")).startswith("2") if dataset.lower() == "taxi" else F.lit(False)
    reason = F.when(head, "header").when(date.isNull(), "dt")
    for c in df.columns:
        if c not in ("dt", "trip_distance"):
            reason = reason.when(F.col(c).isNull(), c)
    return _parsed(df, reason, [date.alias(c) if c == "dt" else F.col(c) for c in df.columns])


def good_trips(lines: DataFrame, with_id: bool = True) -> DataFrame:
    """The trips among ``trip_lines``."""
    df = lines.where("reject is null").drop("reject", "raw")
    if with_id:
        df = df.withColumn("trip_id", content_id(df, [c for c in df.columns if c not in ("dur", "trip_distance")]))
    return df


def read_trips(spark: SparkSession, path, dataset: str, labelled: bool = True,
               with_id: bool = True) -> DataFrame:
    """Trip files written by the cleaning jobs (taxi files may carry trip_distance
    as a 9th column; it is kept by name and is not a feature).

    A field that does not parse is NULL, and a row without a required field is dropped
    (``trip_lines`` keeps it with the reason), whichever columns are used later.  Files carry no trip id, so
    ``trip_id`` is a hash of the row's content: the same trip gets the same id
    in a training run and a later test run, whatever the file splitting, so
    the id-hash train/test split is the same in both.
    """
    return good_trips(trip_lines(spark, path, dataset, labelled), with_id)


def rejects_by_reason(lines: DataFrame) -> DataFrame:
    """(reason, lines): how many lines were rejected for what; good lines under ``accepted``."""
    return lines.groupBy(F.coalesce("reject", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("lines"))


def trip_rejects(spark: SparkSession, path, dataset: str, labelled: bool = True) -> DataFrame:
    """One row: lines read, header lines, and data lines that ``read_trips`` drops."""
    lines = trip_lines(spark, path, dataset, labelled)
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reject") == "header").alias("headers"),
                     F.count_if(F.col("reject").isNotNull() & (F.col("reject") != "header")).alias("rejected"))


def content_id(df: DataFrame, cols: list[str]):
    """A 64-bit hash of the given columns (identical rows share an id)."""
    return F.xxhash64(*[F.col(c) for c in cols])


def read_lines(spark: SparkSession, *dirs: str, with_source: bool = False) -> DataFrame:
    """Raw text lines of one or more directories (e.g. one per year)."""
    df = spark.read.text(list(dirs)).withColumnRenamed("value", "line")
    if with_source:
        df = df.withColumn("source", F.input_file_name())
    return df


def read_csv_header(spark: SparkSession, path, schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with a header line, read with an explicit schema (no inference)."""
    return spark.read.schema(schema).option("header", True).option("mode", mode).csv(_paths(path))


def header_catalogue(spark: SparkSession, pattern) -> list[tuple[tuple[str, ...], list[str]]]:
    """Files grouped by their header: (column names, files), by the first file's name.

    Headers are read by a distributed job, one line a file; what reaches the driver is one row a file.
    """
    first = spark.read.option("wholetext", False).text(_paths(pattern)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    heads = first.where("at = 0").groupBy("file").agg(F.first("value").alias("head")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(heads, key=lambda r: r["file"]):
        names = next(csv.reader([r["head"].lstrip("\ufeff").rstrip("\r")]), [])
        groups.setdefault(tuple(names), []).append(unquote(r["file"]))
    return list(groups.items())


def lacking(names, spec: TaxiSpec, keep: tuple[str, ...] = ()) -> list[str]:
    """Columns of ``spec`` that a header does not have."""
    held = {n.strip().lower() for n in names}
    return [c for c in (spec.pickup, spec.dropoff, *keep, *spec.numbers) if c.lower() not in held]


def read_taxi_csv(spark: SparkSession, pattern, spec: TaxiSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``spec`` from CSV files with a header, found by name whatever their order.

    Files of one glob may have different headers: each layout is one scan, and the scans are united by name.  A
    file without the needed columns is left out (``layouts`` counts them); it is an error if all are.
    Numbers are cast where they parse and NULL elsewhere; ``malformed`` marks rows with another number
    of fields than the header, or with a number that does not parse.  ``keep`` names further columns (as text).
    """
    groups = header_catalogue(spark, pattern)
    fit = [(names, files) for names, files in groups if not lacking(names, spec, keep)]
    if not fit:
        raise ValueError(f"no file of {pattern} has the columns: " + "; ".join(
            f"no {lacking(names, spec, keep)} in the header {list(names)}" for names, _ in groups[:5]))
    scans = [_taxi_layout(spark, names, files, spec, keep) for names, files in fit]
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan)
    return out


def layouts(spark: SparkSession, pattern, spec: TaxiSpec) -> DataFrame:
    """One row per header: its columns, how many files have it, and whether they are read."""
    rows = [(", ".join(names), len(files), not lacking(names, spec)) for names, files in header_catalogue(spark, pattern)]
    return spark.createDataFrame(rows, "header string, files int, used boolean")


def _taxi_layout(spark: SparkSession, names, files: list[str], spec: TaxiSpec, keep: tuple[str, ...]) -> DataFrame:
    held = {}
    for i, n in enumerate(names):
        held.setdefault(n.strip().lower(), i)  # of columns of one name the first
    schema = ", ".join(f"c{i} string" for i in range(len(names))) + ", __broken string"
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("columnPruning", False) \
        .option("columnNameOfCorruptRecord", "__broken").csv(files)
    of = lambda c: F.col(f"c{held[c.lower()]}")
    bad = F.col("__broken").isNotNull()
    for c, kind in spec.numbers.items():
        bad = bad | (of(c).isNotNull() & of(c).try_cast(kind).isNull())
    return df.select(*[of(c).alias(c) for c in [spec.pickup, spec.dropoff, *keep]],
                     *[of(c).try_cast(kind).alias(c) for c, kind in spec.numbers.items()], bad.alias("malformed"))


def read_zones(spark: SparkSession, path) -> DataFrame:
    return read_csv_header(spark, path, schemas.ZONES)
