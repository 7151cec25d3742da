"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from stoptide import catalog
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_its_sql(spark, con, name):
    found, _ = differences(spark, con, SF_DIR, driver.queries()[name],
                           driver.oracle_sql().get(name))
    assert not found, "\n".join(found)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["service_date", "origin", "destination"]
    assert df.count() > 0


def test_every_query_has_its_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(driver.queries())
