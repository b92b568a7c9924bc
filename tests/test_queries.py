"""Every registered query against its check SQL on the smallest sample."""

import pytest

import __spark_entry__ as entries
from martloom import catalog
from tools.check import compare, open_duckdb


@pytest.fixture(scope="module")
def con(small):
    return open_duckdb(small)


def test_every_query_has_check_sql():
    assert set(catalog.queries()) == set(catalog.oracles())
    assert set(catalog.queries()) <= set(entries.queries())


def test_flagship_has_rows(spark):
    assert entries.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_check_sql(spark, con, small, name):
    assert compare(spark, con, small, name) == []
