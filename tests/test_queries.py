"""Each query gives the rows of its SQL."""

import os

import duckdb
import pytest

from tidemark.queries import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        path = f"{DATA}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.select(cols).collect()), key=key) == sorted(want, key=key)
