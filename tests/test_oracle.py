"""Every registered query against its SQL on the smallest tables."""

import os

import __spark_entry__ as entry
import pytest
from oracle_check import compare, duck

from wrenchline.plans.catalog import all_queries
from wrenchline.plans.oracle import all_oracles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(all_queries()) <= set(entry.queries())
