"""Every named query against its SQL on the smallest test data."""

from __future__ import annotations

import os

import pytest

import compare
from balcao.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(catalog.BUILDERS) == set(oracle.QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 80
    assert set(catalog.BUILDERS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.BUILDERS))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(catalog.run(name, spark, FOLDER), con, oracle.sql(name)) == []
