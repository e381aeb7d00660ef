"""Every registered query against its oracle SQL, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare, oracle_connection

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_oracle(spark, sf, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
