"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_sql import compare, connect
from logweave.catalogue import oracle
from logweave.catalogue import queries as registered

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_catalogue_has_sql():
    assert set(registered.all_queries()) == set(oracle.all_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    ok, text = compare(spark, con, SF_DIR, name)
    assert ok, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
