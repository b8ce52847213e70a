"""Every registered query against its SQL, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import compare, connect

SQL = entry.oracle_sql()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck, sf):
    verdict, _ = compare(spark, duck, sf, QUERIES[name], SQL.get(name))
    assert verdict == "ok"


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(registry.SQL) <= set(SQL)
