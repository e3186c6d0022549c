"""Every registered query against its SQL at the smallest scale."""

import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from compare import check_connection, compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_connection(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    _, diff = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert diff is None


def test_entry(spark):
    assert {r["action"] for r in entry.entry(spark).collect()} == set("ADTCS")
