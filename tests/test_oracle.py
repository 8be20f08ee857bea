"""Every registered query that has SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from strandloom.plans import catalogue, interval_queries, stat_queries, table_queries, udf_queries  # noqa: F401

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=repr)
    if name not in catalogue.SQL:
        assert got
        return
    answer = db.sql(catalogue.SQL[name])
    assert sorted(answer.columns) == columns
    at = [answer.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in answer.fetchall()), key=repr)
