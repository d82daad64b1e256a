"""Joins: trips to daily weather, trips to the zone lookup.

Both small sides (one row a day; a few hundred zones) are left to the planner: it
broadcasts a side whose size in bytes is below ``spark.sql.autoBroadcastJoinThreshold``, from the
file sizes or, with adaptive execution, from what the side turned out to be.  Beyond that it
is a shuffle join, where adaptive execution splits a hot key (one day may hold a third of
all trips).  Nothing is cached here and no job runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner equi-join on the trip date.  A trip without a weather day is
    dropped; a day listed twice fans the trip out (as the source does)."""
    return trips.join(weather, on="dt", how="inner")


def enrich_zones(trips: DataFrame, zones: DataFrame, drop_borough: str | None = "Unknown") -> DataFrame:
    """Left join of trips to zone coordinates by ``location_id``.

    Zones in ``drop_borough`` (the out-of-town placeholder) are removed from
    the lookup first, so their trips keep NULL coordinates like any unmatched id.
    """
    z = zones if drop_borough is None else zones.where(F.col("borough") != F.lit(drop_borough))
    return trips.join(z, on="location_id", how="left")
