"""Every query with SQL gives the same rows in DuckDB over the smallest tables."""

import math

import duckdb
import pytest

from radspan import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
    return f"{v:.6f}" if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, db, name):
    got = registry.queries()[name](spark, SF)
    want = db.sql(registry.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    ours = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_every_query_is_known():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"phi_scan_all"}
