import pytest
from oracle import compare

from corpusloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name])
