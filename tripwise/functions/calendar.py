"""Calendar features: day of year, time of day, weekday and peak-hour flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0

# Peak windows are 06:00-10:00 and 16:00-20:00, both ends included.
PEAK_WINDOWS = (("06:00:00", "10:00:00"), ("16:00:00", "20:00:00"))


def _hms_seconds(text: str) -> float:
    h, m, s = (float(p) for p in text.split(":"))
    return s + m * 60 + h * 3600


def day_of_year_fraction(dt: Column) -> Column:
    """Day of year divided by the length of that year (leap aware), in (0, 1]."""
    last = F.make_date(F.year(dt), F.lit(12), F.lit(31))
    return (F.dayofyear(dt).cast("double") / F.dayofyear(last).cast("double"))


def day_fraction(hour: Column, minute: Column, second: Column) -> Column:
    """(s + 60 m + 3600 h) / 86400: the fraction of the day that has passed."""
    secs = second.cast("double") + minute.cast("double") * 60 + hour.cast("double") * 3600
    return secs / F.lit(SECONDS_PER_DAY)


def day_fraction_of_time(hms: Column) -> Column:
    """Day fraction of an ``HH:mm:ss`` string; malformed text gives NULL."""
    parts = F.split(hms, ":")
    return day_fraction(F.try_element_at(parts, F.lit(1)).try_cast("double"),
                        F.try_element_at(parts, F.lit(2)).try_cast("double"),
                        F.try_element_at(parts, F.lit(3)).try_cast("double"))


def weekday_flag(dt: Column) -> Column:
    """1.0 Monday to Friday, 0.0 on weekends (locale free: weekday() is 0 on Monday)."""
    return F.when(F.weekday(dt) < 5, F.lit(1.0)).otherwise(F.lit(0.0))


def peak_flag(dt: Column, frac: Column) -> Column:
    """1.0 on a weekday inside a peak window (ends included), else 0.0."""
    inside = None
    for start, end in PEAK_WINDOWS:
        lo = _hms_seconds(start) / SECONDS_PER_DAY
        hi = _hms_seconds(end) / SECONDS_PER_DAY
        cond = (frac >= F.lit(lo)) & (frac <= F.lit(hi))
        inside = cond if inside is None else (inside | cond)
    return F.when((F.weekday(dt) < 5) & inside, F.lit(1.0)).otherwise(F.lit(0.0))
