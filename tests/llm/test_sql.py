"""Operators that SQL can express, against it, on the smallest driver tables."""

import os

import duckdb
import pytest

from genoloom.llm import queries

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got = con.execute(queries.oracle_sql()[name])
    cols = [x[0] for x in got.description]
    df = queries.queries()[name](spark, DIR)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == sorted(got.fetchall())
