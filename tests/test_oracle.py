"""Every registered query against its DuckDB twin, on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare, duck

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    res = compare(spark, con, SF_SMALL, name, E.queries()[name], E.oracle_sql().get(name))
    assert res.get("values_match") or res.get("oracle") == "none", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "id" in df.columns and "sales" in df.columns
