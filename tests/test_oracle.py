"""Every deterministic query equals its DuckDB SQL on the smallest data set,
and every registered query runs with a stable schema."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck
from tripwise.checks import oracle_sql, queries

QS, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QS[name], SQL[name], SF_SMALL)
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(QS) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    df = QS[name](spark, SF_SMALL)
    cols = df.columns
    assert df.count() >= 0
    assert df.columns == cols


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
