"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from quillmart.plans.registry import ORACLE
from quillmart.plans.registry import QUERIES as REGISTERED
from tests.parity import compare, duck

SF = "/root/testdata/sf0.001"
SQL, QUERIES = ORACLE, REGISTERED


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert "error" not in r, r
    assert "type_diff" not in r, r


def test_every_query_has_an_oracle_and_is_offered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns
