from __future__ import annotations

import pytest

from compare import assert_same, tables
from garnetflow.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    rows = QUERIES[name](spark, SF).toPandas()
    assert_same(rows, con.sql(ORACLE_SQL[name]).df())
    spark.catalog.clearCache()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
