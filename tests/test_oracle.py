"""Every registered query against its SQL, whole results."""

import pytest

import __spark_entry__ as registry
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.warehouse_queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF) == ""


def test_registry_is_complete():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_runs(spark):
    df = registry.entry(spark)
    assert df.columns[0] == "year" and df.count() > 0
