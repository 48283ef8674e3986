"""Every registered query against its SQL twin on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf_dir, con):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["mi_rank"] for r in sorted(rows)] == [1, 2, 3, 4, 5, 6]
