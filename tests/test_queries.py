"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql
from gridcensus.plans import catalogue, contracts, stored_queries
from tests.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(
    catalogue.QUERIES | contracts.QUERIES | stored_queries.QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert name in oracle_sql()
    assert difference(spark, duck, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() == 10
