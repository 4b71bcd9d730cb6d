"""Every query of the engine against its SQL in DuckDB, on the smallest driver tables."""

import os

import duckdb
import pytest

from genoloom.plans import catalog

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, DIR)
    got = con.execute(catalog.oracle_sql()[name])
    cols = [x[0] for x in got.description]
    assert sorted(df.columns) == sorted(cols)
    want = sorted((tuple(r) for r in got.fetchall()), key=str)
    have = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    assert have == want


def test_queries_without_sql_give_rows(spark):
    for name in set(catalog.queries()) - set(catalog.oracle_sql()):
        assert catalog.queries()[name](spark, DIR).count() > 0
