"""Every registered query against its SQL twin."""

import pytest

from compare import connect, difference
from __spark_entry__ import entry, oracle_sql, queries
from pulsefeed.plans.oracle import all_sql
from pulsefeed.plans.queries import all_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(queries()) and set(all_sql()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, sf_dir, con, name):
    assert difference(all_queries()[name](spark, sf_dir), con, all_sql()[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "user_id" not in df.columns
