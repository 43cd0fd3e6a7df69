import pytest
from oracle import compare

from corpusloom.plans import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    compare(spark, catalog.queries()[name], SQL[name])


def test_every_sql_has_a_query():
    assert set(SQL) <= set(catalog.queries())
