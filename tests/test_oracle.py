"""Every registered query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SMALL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_twin(spark, duck, name):
    problems, _ = differences(QUERIES[name](spark, SMALL), ORACLES[name], duck)
    assert problems == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_twin(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
