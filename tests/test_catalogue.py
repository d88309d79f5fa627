"""Every query of the catalogue against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry_points
from comparing import difference

from quotemill.plans import oracles, queries

QUERIES = queries.CATALOGUE
SQL = oracles.oracle_sql()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, given, duck):
    assert difference(QUERIES[name](spark, given), duck, SQL[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["symbol", "date", "open", "high", "low", "close", "volume", "amount", "pct_chg"]
    assert not df.isEmpty()
