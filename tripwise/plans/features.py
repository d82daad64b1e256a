"""One feature definition for training, testing and prediction.

trips -> clusters of start and end point -> inner join to daily weather ->
calendar, distance and peak features -> (labelled only) duration bounds and
the speed three-sigma filter.  Columns are named; ``trip_id`` is carried
through so scored rows keep their identity.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.functions import (chord_distance, day_fraction_of_time, day_of_year_fraction,
                                peak_flag, weekday_flag)
from tripwise.operators.clustering import Centre, assign_clusters
from tripwise.operators.joins import join_weather
from tripwise.operators.outliers import duration_closed, speed_3sigma

TAXI_FEATURES = ["days", "tm", "lat1", "lon1", "lat2", "lon2", "km1", "km2", "dist",
                 "weekday", "peak", "psg", "temp", "rain", "snow", "wspd"]
BIKE_FEATURES = ["days", "tm", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "km1", "km2", "dist",
                 "weekday", "peak", "yr", "gdr", "temp", "rain", "snow", "wspd"]
LABEL = "dur"


def feature_names(dataset: str) -> list[str]:
    d = dataset.lower()
    if d == "taxi":
        return list(TAXI_FEATURES)
    if d == "bike":
        return list(BIKE_FEATURES)
    raise ValueError(f"dataset must be taxi or bike, not {dataset!r}")


def joined_features(trips: DataFrame, weather: DataFrame, centres: Sequence[Centre], dataset: str,
                    labelled: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Feature rows before any duration or speed filter; ``carry`` names further trip columns to keep."""
    feats = feature_names(dataset)
    t = trips
    if "tm" not in t.columns:
        t = t.withColumn("tm", day_fraction_of_time(F.col("time")))
    # A row with a missing or unparseable input (e.g. a malformed time) is
    # rejected here rather than failing the model later; every feature is
    # then non-NULL, since each is a NULL-free function of these inputs.
    inputs = [c for c in feats if c in t.columns] + (["dt"] + ([LABEL] if labelled else []))
    t = assign_clusters(t.dropna(subset=list(dict.fromkeys(inputs))), centres)
    weather = weather.dropna(subset=["dt", "temp", "rain", "snow", "wspd"])
    j = join_weather(t, weather)
    dt = F.col("dt")
    j = (j.withColumn("days", day_of_year_fraction(dt))
          .withColumn("dist", chord_distance(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))
          .withColumn("weekday", weekday_flag(dt))
          .withColumn("peak", peak_flag(dt, F.col("tm"))))
    cols = (["trip_id"] if "trip_id" in j.columns else []) + list(carry) + ([LABEL] if labelled else []) + feats
    return j.select(*cols)


def build_features(trips: DataFrame, weather: DataFrame, centres: Sequence[Centre], dataset: str,
                   labelled: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """The model input: labelled rows are bounded (120..3600 s, closed) and
    speed outliers removed; unlabelled rows are only joined and projected."""
    j = joined_features(trips, weather, centres, dataset, labelled, carry)
    if not labelled:
        return j
    return speed_3sigma(duration_closed(j, LABEL), "dist", LABEL)
