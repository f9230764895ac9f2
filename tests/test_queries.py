"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from checks import all_oracles, all_queries
from checks.compare import compare, connect

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, sf, con, name):
    equal, note = compare(spark, con, sf, QUERIES[name], ORACLES.get(name))
    assert equal, note


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["city", "postings", "companies"]
    assert df.count() > 0


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
