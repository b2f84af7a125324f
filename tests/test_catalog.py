"""Every query against its SQL twin on the smallest tables."""

import pytest

from check_queries import compare, connect
from epilink.plans.catalog import QUERIES
from epilink.plans.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ok, note = compare(spark, duck, FOLDER, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
