"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables; the others run."""

import os

import duckdb
import pytest

from omicspark.queries import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"graph_random_walk", "graph_communities", "enrich_mixture"}


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 5) + 0.0
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in ORACLE_SQL:
        rel = duck.sql(ORACLE_SQL[name])
        assert sorted(rel.columns) == columns
        at = [rel.columns.index(c) for c in columns]
        expected = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
        assert len(rows) == len(expected)
        different = [(a, b) for a, b in zip(rows, expected, strict=True) if a != b and not all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-5 * max(1, abs(x))) for x, y in zip(a, b, strict=True))]
        assert not different[:3]
