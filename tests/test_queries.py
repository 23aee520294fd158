"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from check import duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(entry.lab_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", entry.lab_queries())
def test_query(spark, con, name):
    names, rows = spark_rows(entry.queries()[name](spark, SF))
    want_names, want_rows = duck_rows(con, entry.oracle_sql()[name])
    assert [n.lower() for n in names] == [n.lower() for n in want_names]
    assert rows == want_rows
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
