"""Every query against its SQL twin."""

import pytest

import __spark_entry__ as entry_module
from suite.compare import difference, oracle_connection
from suite.oracle import ORACLE_SQL
from suite.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE_SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    table = entry_module.entry(spark)
    assert table.count() > 0 and len(table.columns) == 87


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal_to_sql(spark, oracle, name):
    result = QUERIES[name](spark, SMALL)
    assert difference(result, oracle, ORACLE_SQL[name]) is None
