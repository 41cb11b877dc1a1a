"""Every registered query against its SQL, or for the others that it runs."""

import pytest

import oracle
from conftest import SMALL
from rowloom import plans

QUERIES, SQL = plans.all_queries(), plans.all_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert oracle.compare(spark, duck, QUERIES[name], SQL[name], SMALL) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
