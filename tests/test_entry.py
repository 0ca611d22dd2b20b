"""Driver contract: entry() smoke run and every registered query vs its oracle."""

import pytest

import __spark_entry__ as entry
from tidemark.plans.catalog import registry
from tests.conftest import SF_SMALL
from tidemark.plans.verify import compare, duckdb_connection


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(registry()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert ok, msg
