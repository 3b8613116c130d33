"""Every registered query: equal to its SQL where it has one, else it yields rows."""

import os

import pytest

from dunlin.plans import QUERIES, SQL
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"auto_cluster"}  # the four grids it runs have tests of their own


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    difference, _ = compare(duck, QUERIES[name](spark, SF_DIR), SQL[name])
    assert difference == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_yields_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).limit(1).count() == 1
