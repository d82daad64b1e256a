"""Registry of checked queries: name -> Spark callable, name -> DuckDB SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.sources import standins as sv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.table(spark, sf_dir, "events")


def weather_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.weather(events(spark, sf_dir))


def r(c, n: int):
    return F.round(F.col(c) if isinstance(c, str) else c, n)
