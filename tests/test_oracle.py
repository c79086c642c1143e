"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries
from stationflow.testing.compare import compare, duckdb_connection

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    if name not in oracle_sql():
        assert df.count() >= 0
        return
    ok, msg = compare(df, oracle_sql()[name], con)
    assert ok, msg


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "trip_count" in df.columns
