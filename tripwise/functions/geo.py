"""Geometry: unit-sphere coordinates, chord distance, speed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Earth radius in metres used for the chord length.
EARTH_RADIUS_M = 6371000.0


def cartesian(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Unit-sphere (x, y, z) of a latitude/longitude pair in degrees."""
    rlat, rlon = F.radians(lat), F.radians(lon)
    return (F.cos(rlat) * F.cos(rlon), F.cos(rlat) * F.sin(rlon), F.sin(rlat))


def chord_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Straight-line (chord, not great-circle) distance in metres."""
    x1, y1, z1 = cartesian(lat1, lon1)
    x2, y2, z2 = cartesian(lat2, lon2)
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2) + F.pow(z1 - z2, 2)) * F.lit(EARTH_RADIUS_M)


def speed(dist: Column, dur: Column) -> Column:
    """Metres per second; NULL (not an error) for a zero duration."""
    return F.try_divide(dist, dur)
