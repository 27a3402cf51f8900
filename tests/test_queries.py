"""Every registered query against its DuckDB SQL on the smallest tables (rows, column names, values)."""

import re

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL
from .oracle import compare, duck

SQL = entry.oracle_sql()
#: The training-data queries have tests of their own beside them; not all of them can be said in SQL.
OWN_TESTS = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry.queries().items() if not OWN_TESTS.match(n)}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == {n for n in SQL if not OWN_TESTS.match(n)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, rows, _, detail = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert ok, detail
    assert rows > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "customer_id" in df.columns
