"""Sinks: headerless or header CSV, comma-joined text, scored outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_lines(df: DataFrame, path: str, cols: list[str] | None = None, sep: str = ",",
                mode: str = "overwrite") -> str:
    """One text line per row: the columns joined by ``sep``; a NULL field is empty, so no column moves."""
    cols = cols or df.columns
    df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("value")) \
      .write.mode(mode).text(path)
    return path


def write_scored(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None, replace: str = "all") -> str:
    """Scored rows (features, prediction, residual) as Parquet, or headerless CSV.

    ``partition_by`` (e.g. the date) lets later reads prune partitions.  Rows are first brought together by it, which
    keeps the number of files near the number of days instead of tasks times days; a day with very many rows is
    split over several tasks (AQE).  ``replace="days"`` overwrites only the partitions that ``df`` has rows of, and
    leaves all other files as they are."""
    if replace not in ("all", "days"):
        raise ValueError(f"replace must be all or days, not {replace!r}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic" if replace == "days" else "static")
    if fmt == "csv":
        w = w.option("header", False)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path
