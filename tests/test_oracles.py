"""Every query with SQL equals what DuckDB makes of that SQL."""

import pytest
from compare import connect, difference
from conftest import SMALL

from riskframe.oracle import all_oracles
from riskframe.queries import all_queries


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, duck, name):
    assert difference(all_queries()[name](spark, SMALL), duck, all_oracles()[name]) is None
