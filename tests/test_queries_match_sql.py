"""Every query with SQL, against that SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import difference, sql_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    actual = queries()[name](spark, SF_DIR).toPandas()
    assert difference(actual, con.sql(oracle_sql()[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    assert entry(spark).count() > 0
