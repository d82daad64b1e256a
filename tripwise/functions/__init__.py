"""Scalar feature functions as Spark column expressions (all JVM-side)."""

from tripwise.functions.calendar import (day_fraction, day_fraction_of_time, day_of_year_fraction,
                                         peak_flag, weekday_flag)
from tripwise.functions.geo import cartesian, chord_distance, speed
from tripwise.functions.text import normalise_date, normalise_time

__all__ = [
    "day_fraction", "day_fraction_of_time", "day_of_year_fraction", "peak_flag", "weekday_flag",
    "cartesian", "chord_distance", "speed",
    "normalise_date", "normalise_time",
]
