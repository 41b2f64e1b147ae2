"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from mainspool.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in entry.oracle_sql()
    assert oracle.difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
