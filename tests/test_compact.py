"""Small volumes as rows against the same volumes by grouped rows of voxels, which large ones are."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_slices import _volumes

from radspan.operators import compact, ranks, volume_stats


def same(some, other):
    assert set(some) == set(other)
    for k, r in other.items():
        for f, x in r.asDict().items():
            assert some[k][f] == (pytest.approx(x, rel=1e-9, abs=1e-9) if isinstance(x, float) or isinstance(x, list) and x else x), (k, f)


def test_many_small_volumes_are_rows(spark, monkeypatch):
    """F16: no voxel becomes a row, each array is shuffled once, and no work table is written."""
    for module in (volume_stats, ranks):
        monkeypatch.setattr(module, "work_table", lambda df, name: pytest.fail(f"work table {name}"))
    df = spark.range(300).select("id", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (F.col("id") * i % 97).cast("double")).alias("v"))
    found = volume_stats.volume_stats(df, "id", "v", (4, 4, 4))
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(rows) == 300 and "Generate" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    r = next(r for r in rows if r.id == 7)
    v = np.arange(1, 65) * 7 % 97
    assert (r.volume_mean, r.volume_std, r.volume_p25, r.volume_max) == pytest.approx((v.mean(), v.std(), np.percentile(v, 25), v.max()))


@pytest.mark.parametrize("most", [0, 1500])
def test_lines_of_small_and_large_volumes(spark, monkeypatch, most):
    """With 1500 voxels at most, some of these volumes are small and some large."""
    rows = [(k, z, y, v[z, y].tolist()) for k, v in _volumes().items() for z in range(v.shape[0]) for y in range(v.shape[1])]
    lines = spark.createDataFrame([*rows, ("twice", 0, 0, [1.0]), ("twice", 0, 0, [1.0]), ("nan", 0, 0, [float("nan")]), (None, 0, 0, [1.0])], "volume string, z int, y int, line array<double>")
    found = lambda: {r.volume: r for r in volume_stats.line_stats(lines).collect()}
    small = found()
    monkeypatch.setattr(compact, "MOST", most)
    assert set(small) == set(_volumes())
    same(small, found())


def test_histograms_and_images_of_any_size(spark, monkeypatch):
    rng = np.random.default_rng(2)
    images = [(0, rng.random(600) * 9), (1, rng.random(40)), (1, rng.random(30)), (2, np.full(50, 0.1)), (3, np.zeros(20)), (4, np.round(rng.normal(size=700), 1)), (None, rng.random(5))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in images] + [(5, []), (6, None), (7, [1.0, None]), (8, [3.0])], "k int, v array<double>")
    lines = df.where("k IS NULL OR k < 5").selectExpr("k AS volume", "v AS line")
    found = lambda: [{str(i): r for i, r in enumerate(sorted(x.collect(), key=str))} for x in (volume_stats.image_stats(df, "k", "v", 16), volume_stats.histograms(lines, 20))]
    small = found()
    assert [len(x) for x in small] == [11, 5]  # both images of key 1 have the figures of their values together
    for most in (0, 100):
        monkeypatch.setattr(compact, "MOST", most)
        for x, y in zip(small, found(), strict=True):
            same(x, y)


def test_repeated_keys_and_odd_arrays(spark, monkeypatch):
    v = [float(i * i % 31) for i in range(8)]
    df = spark.createDataFrame([(0, v), (0, v), (1, v), (1, [1.0]), (2, v[:7] + [None]), (3, v[:7] + [float("inf")]), (4, None), (None, v), (5, [-x for x in v])], "k int, v array<double>")
    found = lambda: {str(i): r for i, r in enumerate(sorted(volume_stats.volume_stats(df, "k", "v", (2, 2, 2)).collect(), key=str))}
    small = found()
    assert sorted(r.k for r in small.values() if r.volume_mean is not None) == [1, 1, 5]
    monkeypatch.setattr(compact, "MOST", 0)
    same(small, found())
