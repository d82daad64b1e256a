"""Dates of raw bike lines against their SQL, on rows of our own: ISO and M/d/yyyy dates, quoted lines, headers,
malformed lines, a repeated and a null key."""

import datetime as dt

import duckdb
from __spark_entry__ import oracle_sql, queries
from oracle_compare import compare


def test_normalise_date_matches_its_sql(spark, tmp_path):
    at = dt.datetime(2024, 2, 29, 7, 5, 9)
    ids = [1, 2, 3, 6, 7, 13, 14, 17, 21, 21, 42, 63, None]  # % 3: ISO date, % 7: quoted, % 13: malformed, % 17: header
    rows = [(i, at + dt.timedelta(days=n), 60 + n, "view", 30.0 + n, "{}") for n, i in enumerate(ids)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    name = "f_normalise_date"
    got = compare(spark, con, name, queries()[name], oracle_sql()[name], str(tmp_path))
    assert got["ok"], got
    assert got["rows"] == 12 and "types" not in got  # 9 keys once, 21 four times, less those dropped
    out = {r["event_id"]: r for r in queries()[name](spark, str(tmp_path)).collect()}
    assert (out[42]["dt_iso_kept"], out[42]["dt_strict"]) == ("2024-03-10", None)
    assert out[14]["dt_iso_kept"] == out[14]["dt_strict"] == "2024-03-06"
