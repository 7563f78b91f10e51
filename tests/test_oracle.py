"""Every registered query on the smallest tables, against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", queries())
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, name, FOLDER)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
