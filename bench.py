"""Time the headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; print one JSON line.

Each query is executed in full with the no-op sink (every row produced, nothing
collected to the driver).  Every headline query first runs once at sf0.001,
untimed, so the timings measure execution, not one-off code generation and JIT
compilation (which a long run on a cluster pays once per executor).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "speed_3sigma", "features_taxi", "features_bike", "features_bike_pred", "clean_bike", "union_years",
    "clean_taxi_yellow", "cleaning_counts", "assign_clusters", "elbow_select", "zone_enrich",
    "score_test_linear", "grid_argmin", "gd_linear", "grid_lr", "kmeans_fit", "fit_dt", "fit_rf", "grid_dt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    from tripwise.checks import queries
    from tripwise.session import get_session
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory="16g")
    qs = queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for n in names:
        qs[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
