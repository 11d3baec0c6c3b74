"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
import oracle
from offermill.suite.queries import QUERIES as OWN

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
OTHERS = [name for name in SQL if name not in OWN]


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


def test_every_query_has_a_statement():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [*OWN, *OTHERS])
def test_same_rows(spark, duck, name):
    _, _, difference = oracle.compare(spark, duck, QUERIES[name], SQL[name], SMALL)
    assert difference is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
