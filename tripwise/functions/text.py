"""Text clean-up used by the raw-file cleaning jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_date(text: Column, keep_iso: bool) -> Column:
    """ISO ``yyyy-MM-dd`` text of a ``M/d/yyyy`` date.

    With ``keep_iso`` a value that already contains '-' is passed through
    unchanged; without it every value must be ``M/d/yyyy``.  Unparseable
    dates become NULL (strict parsing; callers count the rejects).
    """
    parsed = F.date_format(F.try_to_date(text, "M/d/yyyy"), "yyyy-MM-dd")
    if keep_iso:
        return F.when(text.contains("-"), text).otherwise(parsed)
    return parsed


def normalise_time(text: Column) -> Column:
    """``HH:mm:ss`` text; ``HH:mm`` gets ':00' appended first.  Invalid -> NULL."""
    full = F.when(F.size(F.split(text, ":")) == 2, F.concat(text, F.lit(":00"))).otherwise(text)
    return F.date_format(F.try_to_timestamp(full, F.lit("H:m:s")), "HH:mm:ss")
