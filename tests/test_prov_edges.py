"""Provenance edges come from rows, not from one list by source: rows without an id have edges too."""

import duckdb

from radspan import registry


def test_prov_edges_of_odd_rows(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "c"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = registry.queries()["prov_edges"](spark, str(tmp_path))
    assert "collect_set" not in df._jdf.queryExecution().toString()
    got = [(r.edge, r.source, r.target) for r in df.collect()]
    assert sorted(map(str, got)) == sorted(map(str, con.sql(registry.oracle_sql()["prov_edges"]).fetchall()))
