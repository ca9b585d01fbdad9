"""Queries over volumes against their SQL, on tables of odd volumes."""

import random

import duckdb

from radspan import registry


def test_figures_of_a_volume_that_is_not_whole(spark, tmp_path):
    draw = random.Random(3)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(16)]) for i in range(150)]  # the second volume lacks lines of its second slice
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = registry.queries()["volume_metrics"](spark, str(tmp_path))
    want = con.sql(registry.oracle_sql()["volume_metrics"])
    at = [want.columns.index(c) for c in got.columns]
    plain = lambda v: f"{v + 0.0:.5f}" if isinstance(v, float) else str(v)
    ours = sorted(tuple(map(plain, r)) for r in got.collect())
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall()) and len(ours) == 2
