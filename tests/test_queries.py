"""Every registered query against DuckDB on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import compare, oracle_connection
from tests.conftest import SF_DIR

QUERIES = registry.queries()
LLM = set(registry.llm.queries()) if registry.llm else set()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) <= LLM


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry_returns_one_row(spark):
    assert registry.entry(spark).count() == 1
