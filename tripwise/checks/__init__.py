"""Checked queries, one per operator, with DuckDB oracles where deterministic."""

from tripwise.checks import core, cleaning, io, ml  # noqa: F401  (registration)
from tripwise.checks.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
