"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(rec[i]) for i in order) for rec in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                 "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diffs(sdf, res):
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    d_types = {d[0]: str(d[1]) for d in res.description}
    return {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}


def compare(spark, con, name, fn, sql, sf_dir, tol=0.0):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="rows only")
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    info = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    td = type_diffs(sdf, res)
    if td:
        info["types"] = td
    if sorted(scols) != sorted(dcols):
        return dict(info, ok=False, note=f"columns {scols} vs {dcols}")
    a, b = rows_of(srows, scols), rows_of(drows, dcols)
    if len(a) != len(b):
        return dict(info, ok=False, note="row count")
    bad = 0
    first = None
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            same = u == v or (isinstance(u, float) and isinstance(v, float) and abs(u - v) <= tol * max(1, abs(u)))
            if not same:
                bad += 1
                first = first or (x, y)
                break
    return dict(info, ok=bad == 0, note=f"{bad} differing rows; first {first}" if bad else "")


def main(argv):
    sys.path.insert(0, ".")
    from tripwise.checks import oracle_sql, queries
    from tripwise.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory="16g")
    con = duck(sf_dir)
    qs, sq = queries(), oracle_sql()
    fails = 0
    for n in names:
        try:
            res = compare(spark, con, n, qs[n], sq.get(n), sf_dir)
        except Exception as e:  # report and continue
            res = dict(name=n, ok=False, note=f"{type(e).__name__}: {str(e)[:400]}")
        fails += res.get("ok") is False
        print(res, flush=True)
    print("FAILS", fails)


if __name__ == "__main__":
    main(sys.argv)
