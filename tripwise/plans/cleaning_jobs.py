"""The cleaning jobs as end-to-end Spark jobs: files in, cleaned files out.

bike:  one text directory per year -> per-year rules -> union -> comma-joined
       text (the 11 cleaned fields), plus the row count of each year.
taxi:  CSV files with a header (glob), columns by name -> yellow: malformed rows
       dropped -> duration, non-null and city-box steps -> headerless CSV, plus
       the counts of rows read, malformed and without a readable time, and the step counts.

Counts are metrics of the write itself (``Observation``): one pass over the
input, nothing cached, whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripwise.operators import cleaning as cl
from tripwise.operators.outliers import duration_open
from tripwise.sources import readers, writers

BIKE_PROFILES = {"2015": cl.BIKE_2015, "2016": cl.BIKE_2016}


def clean_bike_job(spark: SparkSession, year_dirs: dict[str, str], out_dir: str,
                   profiles: dict[str, cl.BikeProfile] | None = None) -> dict:
    from pyspark.sql import Observation
    profiles = profiles or BIKE_PROFILES
    allc = cl.clean_bike_years({y: readers.read_lines(spark, path) for y, path in year_dirs.items()}, profiles)
    obs = Observation("bike_counts")
    observed = allc.observe(obs, *[F.count_if(F.col("_year") == F.lit(y)).alias(y) for y in year_dirs])
    writers.write_lines(observed, out_dir, cl.BIKE_OUT)
    counts = {y: int(v) for y, v in obs.get.items()}
    return dict(path=out_dir, counts=counts, total=sum(counts.values()))


def clean_taxi_job(spark: SparkSession, pattern: str, out_dir: str, spec: cl.TaxiSpec = cl.YELLOW) -> dict:
    from pyspark.sql import Observation
    raw = readers.read_taxi_csv(spark, pattern, spec)
    seen, obs = Observation("taxi_rows"), Observation("taxi_counts")
    p = cl.project_taxi(raw, spec, keep=("malformed",))
    p = p.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("malformed").alias("malformed"),
                  F.count_if(F.col("Duration").isNull()).alias("no_time"))
    p = duration_open((p.where(~F.col("malformed")) if spec.drop_malformed else p).drop("malformed"))
    p = p.observe(obs, *cl.step_count_exprs(spec))
    writers.write_csv(cl.bounding_box(cl.coords_not_null(p), spec), out_dir, header=False)
    return dict(path=out_dir, **{k: int(v) for o in (seen, obs) for k, v in o.get.items()})


def main(argv: list[str]) -> int:
    """python -m tripwise.plans.cleaning_jobs bike <out_dir> <year>=<text_dir> [<year>=<text_dir> ...]
    python -m tripwise.plans.cleaning_jobs yellow|green <out_dir> <csv glob>"""
    if len(argv) < 3 or argv[0] not in ("bike", "yellow", "green"):
        print(main.__doc__)
        return 1
    from tripwise.session import get_session
    spark = get_session()
    if argv[0] == "bike":
        dirs = dict(a.split("=", 1) for a in argv[2:])
        unknown = set(dirs) - set(BIKE_PROFILES)
        if unknown:
            print(f"no cleaning rules for year(s) {sorted(unknown)}; known: {sorted(BIKE_PROFILES)}")
            return 1
        res = clean_bike_job(spark, dirs, argv[1])
    else:
        res = clean_taxi_job(spark, argv[2], argv[1], cl.YELLOW if argv[0] == "yellow" else cl.GREEN)
    for k, v in res.items():
        print(f"{k}: {v}")
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main(sys.argv[1:]))
