"""Every registered query against its SQL twin: names, types and values."""

import os

import compare
import pytest

import __spark_entry__ as registered

SF = os.environ.get("GAUGELAKE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_a_twin():
    assert set(registered._QUERIES) <= set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() > 0 and "dispersion_score" in df.columns


@pytest.mark.parametrize("name", list(registered._QUERIES))
def test_query(spark, con, name):
    assert compare.compare(registered.queries()[name](spark, SF), con, registered.oracle_sql()[name]) == []
