"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], ORACLES[name], SF_SMALL)
    assert r["cols"], (r["s_cols"], r["d_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["values"], r["diff"]
