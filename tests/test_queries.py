"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from martbrook.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert difference(entry.queries()[name](spark, FOLDER), connection, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5
