"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    rows, problem = oracle.compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None
    assert rows >= 0


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["road_class", "roads", "total_km"]
