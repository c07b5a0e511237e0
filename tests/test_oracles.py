"""Every registered query against its DuckDB oracle (the driver's gate) at sf0.001."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck
from starloom.plans.catalog import oracle_sql, queries

QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(SQL))
    assert missing == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL.get(name), con)
    assert r["status"] == "match", r
