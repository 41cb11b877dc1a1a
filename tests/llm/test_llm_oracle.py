"""Queries of this part against their SQL."""

import pytest

import oracle
from conftest import SMALL
from rowloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_same_as_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SMALL), queries.all_queries()[name], queries.all_sql()[name], SMALL) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.all_queries()) == list(range(1, 14))
