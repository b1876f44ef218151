"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
import check
from tidemark.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.REGISTRY))
def test_query_equals_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF_DIR, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(registry.REGISTRY) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_stable_columns(spark):
    assert entry_module.entry(spark).columns == [
        "item_type", "type", "ID", "Message", "_LastWritten", "_InsertTime", "_IsCreated",
    ]
