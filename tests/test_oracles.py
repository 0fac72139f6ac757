"""Every registered query against its DuckDB text on the smallest data."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = entry.SMOKE_DIR
QUERIES, SQLS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    if name not in SQLS:
        pytest.skip("no SQL; tested against a brute-force version")
    ours, theirs = compare(spark, con, QUERIES[name], SQLS[name], SF)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
