"""Every named query against its SQL, on the smallest data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as spark_entry  # noqa: E402
from check import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(spark_entry.queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, name, spark_entry.queries()[name], spark_entry.oracle_sql().get(name)) is None


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
