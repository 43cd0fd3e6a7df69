"""Comparison of a query with its SQL in DuckDB."""

import math
import os

import pytest

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck():
    import duckdb

    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]

    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    return sorted(repr(tuple(norm(r[i]) for i in at)) for r in data)


def compare(spark, query, sql):
    c = duck().execute(sql)
    want = rows([d[0] for d in c.description], c.fetchall())
    df = query(spark, DATA)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want
