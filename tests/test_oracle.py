"""Every registered query against its SQL on the given tables."""

import os

import pytest

import compare
from texttrend.plans.catalog import QUERIES
from texttrend.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def con(folder):
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return compare.duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, folder, name):
    assert compare.difference(spark, con, name, folder) is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 12
