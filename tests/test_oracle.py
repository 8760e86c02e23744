"""Every registered query against its oracle SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect
from tillmart.registry import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_oracle(spark, db, sf_dir, name):
    assert compare(spark, db, sf_dir, name) == ""


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["business_date", "weekday"]
    assert not df.isEmpty()
