"""An append-only table of small entries on shared storage.

``put`` appends one entry as one row, which is one file: a reader sees it whole or not at all, and a later
entry of the same key replaces an earlier one.  Published versions of a model (``plans/bundle.py``) and the
finished parts of a search (``Ledger`` given as ``journal``) are kept this way.  Entries are as large as what they describe
(paths, centres, thresholds, errors of grid cells), never as large as data, so the table is read whole.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "key string, number long, payload string"


def key_of(**parts) -> str:
    """The same key for the same named parts, in any order."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def fingerprint(df: DataFrame) -> str:
    """Of all rows, whatever their order and partitions: their count, and sum and exclusive or of their hashes."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    row = df.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return key_of(columns=df.dtypes, n=row["n"], s=str(row["s"]), x=row["x"])


class Ledger:
    """Entries of the table at ``path``, which is begun if it is not there."""

    def __init__(self, spark: SparkSession, path: str, begin: bool = True):
        self.spark, self.path = spark, path.rstrip("/")
        if begin:
            self._append("begin", -1, None)
        self.number, self.entries = 0, {}
        rows = spark.read.schema(ENTRY).json(self.path).filter("key <> 'begin'").collect()
        for r in sorted(rows, key=lambda r: (r["number"], r["payload"])):
            self.entries[r["key"]] = json.loads(r["payload"])
            self.number = r["number"] + 1

    def _append(self, key: str, number: int, payload: str | None) -> None:
        self.spark.createDataFrame([(key, number, payload)], ENTRY).coalesce(1).write.mode("append").json(self.path)

    def get(self, key: str):
        return self.entries.get(key)

    def put(self, key: str, payload) -> None:
        self._append(key, self.number, json.dumps(payload, sort_keys=True))
        self.number, self.entries[key] = self.number + 1, payload

    def same_rows(self, df: DataFrame, path: str, over: list[str]) -> tuple[DataFrame, str]:
        """``df``, stored at ``path``, or the rows an earlier call kept here if they have equal values in the columns ``over``, so
        that numbers dealt to rows stay what they were; and a key of those rows."""
        print_ = fingerprint(df.select(*over))
        kept = self.get(f"rows {print_}")
        if kept is None:
            kept = path
            self.put(f"rows {print_}", path)
        return self.spark.read.schema(df.schema).parquet(kept), key_of(rows=kept, print=print_)
