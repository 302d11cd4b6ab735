"""Every registered query against its SQL in another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import difference, oracle_connection
from tests.conftest import CHECKED

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = oracle_connection(CHECKED)
    yield connection
    connection.close()


OWN = sorted(set(QUERIES) - set(registry.llm_queries() if registry.llm else ()))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, CHECKED), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", OWN)
def test_oracle_returns_rows(duck, name):
    assert duck.execute(f"select count(*) from ({ORACLES[name]}) q").fetchall()[0][0] > 0


def test_entry_returns_rows(spark):
    assert registry.entry(spark).count() > 0
