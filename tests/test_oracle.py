"""Every registered query with SQL must give the same values in both engines."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_values(spark, data_dir, con, name):
    assert compare(entry.queries()[name](spark, data_dir), con, entry.oracle_sql()[name]) == []


def test_sql_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert [r["split"] for r in rows] == ["train", "validation", "test"]
