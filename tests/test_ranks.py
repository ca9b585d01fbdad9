"""Exact ranks of many groups in two passes, against numpy."""

import numpy as np
import pytest

from radspan.operators import profile, ranks


def test_percentiles_of_groups_large_small_and_odd(spark):
    rng = np.random.default_rng(0)
    groups = {"large": rng.normal(size=60_000).tolist(), "ties": rng.integers(0, 4, 30_000).astype(float).tolist(), "small": [3.0, 1.0, 2.0], "one": [5.0], "ends": [float("-inf"), 1.0, 2.0, float("inf")], "skewed": (rng.random(40_000) ** 40).tolist()}
    rows = [(g, x) for g, v in groups.items() for x in v] + [("none", None), ("none", float("nan")), ("small", None), ("small", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    wanted = {"p0": 0.0, "p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: r for r in ranks.percentiles(df, "g", "v", wanted).collect()}
    assert got["none"].n == 0 and got["none"].p50 is None and got["small"].n == 3
    for g, v in groups.items():
        if g != "ends":
            assert [got[g][k] for k in wanted] == pytest.approx([np.percentile(v, 100 * q) for q in wanted.values()], rel=1e-12)
    assert (got["ends"].p0, got["ends"].p50, got["ends"].p100) == (float("-inf"), 1.5, float("inf"))


def test_brackets_that_sketches_give_hold_their_rank(spark):
    """Values far beyond ACCURACY, where brackets are narrow."""
    df = spark.range(300_000).selectExpr("'g' as g", "cast(pmod(id * 7919, 300000) as double) as v")
    r = ranks.order_statistics(df, "g", "v", {"a": ranks.below(0.3), "b": ranks.above(0.3), "c": ranks.nearest(0.25)}).first()
    assert (r.a, r.b, r.c) == (89_999.0, 90_000.0, 75_000.0)


def test_a_profile_scans_its_table_twice(spark, tmp_path):
    df = spark.range(5000).selectExpr(*[f"cast(id * {k} as double) as c{k}" for k in range(1, 9)])
    df.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    tracker = spark.sparkContext.statusTracker
    assert tracker is not None
    rows = profile.numeric_profile(df, df.columns)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/t") == 0  # what is left to do reads work tables only
    assert sorted((r.column, r.median) for r in rows.collect()) == [(f"c{k}", 2499.5 * k) for k in range(1, 9)]
