"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks import compare as cmp

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return cmp.connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    ok, text = cmp.compare(spark, duck, SF, name, entry.queries()[name], SQL.get(name))
    assert ok, text


def test_no_stray_sql():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert sum(r["n"] for r in entry.entry(spark).collect()) > 0
