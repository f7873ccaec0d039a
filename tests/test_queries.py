"""Every catalog query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from duskwatch.plans.catalog import QUERIES
from duskwatch.plans.oracle import ORACLE



def test_entry_offers_the_catalog():
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    return connect(sf_small)


def test_every_query_has_a_statement():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_statement(spark, con, sf_small, name):
    assert differences(QUERIES[name](spark, sf_small), con, ORACLE[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
