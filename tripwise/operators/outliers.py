"""Duration bounds and the speed three-sigma outlier filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.functions.geo import speed

# Trips shorter than 2 minutes or longer than an hour are dropped.
MIN_DURATION_S = 120.0
MAX_DURATION_S = 3600.0


def duration_closed(df: DataFrame, dur: str = "dur", lo: float = MIN_DURATION_S,
                    hi: float = MAX_DURATION_S) -> DataFrame:
    """lo <= dur <= hi (the bound used after the weather join and for bike files)."""
    return df.where((F.col(dur) >= F.lit(lo)) & (F.col(dur) <= F.lit(hi)))


def duration_open(df: DataFrame, dur: str = "Duration", lo: float = MIN_DURATION_S,
                  hi: float = MAX_DURATION_S) -> DataFrame:
    """lo < dur < hi (the bound of the taxi cleaning jobs)."""
    return df.where((F.col(dur) > F.lit(lo)) & (F.col(dur) < F.lit(hi)))


def speed_stats(df: DataFrame, dist: str = "dist", dur: str = "dur") -> DataFrame:
    """One row: mean and population standard deviation of dist / dur.

    A single global aggregate: partial sums per partition, one tiny final merge.
    """
    s = speed(F.col(dist), F.col(dur))
    return df.agg(F.avg(s).alias("speed_avg"), F.stddev_pop(s).alias("speed_sd"))


def day_moments(df: DataFrame, day: str = "dt", dist: str = "dist", dur: str = "dur") -> DataFrame:
    """The state of a speed statistic: one row a day with n, mean and m2 (squared deviations from the mean).

    States of disjoint rows merge exactly, so a new day's trips shift the bounds without reading the old ones again.
    """
    s = speed(F.col(dist), F.col(dur))
    return df.groupBy(F.col(day).alias("day")).agg(
        F.count(s).alias("n"), F.avg(s).alias("mean"), (F.var_pop(s) * F.count(s)).alias("m2")).where("n > 0")


def merge_moments(states: DataFrame) -> DataFrame:
    """States of the same day, from several batches, as one row a day."""
    mean = F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    # Deviations are taken from the merged mean of each day: no difference of large squares.
    of = states.groupBy("day").agg(mean.alias("mean_all"))
    return states.join(of, "day").groupBy("day").agg(
        F.sum("n").alias("n"), F.first("mean_all").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("mean_all"), 2)).alias("m2"))


def stats_of_moments(states: DataFrame) -> DataFrame:
    """One row as ``speed_stats`` gives it, from a table of states (a row a day)."""
    whole = merge_moments(states.select(F.lit(0).alias("day"), "n", "mean", "m2"))
    return whole.select(F.col("mean").alias("speed_avg"), F.sqrt(F.col("m2") / F.col("n")).alias("speed_sd"))


def speed_3sigma(df: DataFrame, dist: str = "dist", dur: str = "dur", k: float = 3.0) -> DataFrame:
    """Keep rows with avg - k*sd < dist/dur < avg + k*sd (both strict).

    The two statistics come from ONE aggregate job (partial sums per task, a
    one-row merge) and enter the filter as literals, so the row filter is a
    plain predicate, evaluated once per row in the scan stage, and repeated
    actions on the result see the same bounds.  ``df`` is read twice; persist
    it first when it is expensive to recompute.
    """
    row = speed_stats(df, dist, dur).first()
    m, sd = row["speed_avg"], row["speed_sd"]
    if m is None or sd is None:          # no rows: nothing passes
        return df.where(F.lit(False))
    s: Column = speed(F.col(dist), F.col(dur))
    return df.where((s < F.lit(m + k * sd)) & (s > F.lit(m - k * sd)))
