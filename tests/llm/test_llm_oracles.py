"""Every query of the subpackage with SQL equals what DuckDB makes of that SQL."""

import pytest
from compare import connect, difference

from riskframe.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.all_oracles()))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(queries.all_queries()[name](spark, folder), connect(folder), oracle.all_oracles()[name]) is None
