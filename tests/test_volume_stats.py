"""Volume and image statistics on arrays whose figures are known."""

import numpy as np
import numpy_volume
import pytest
from pyspark.sql import functions as F

from radspan.operators import volume, volume_stats


def air(size=(8, 32, 32)):
    """1 and 3 in turn: mean 2, deviation 1."""
    return 2.0 + (-1.0) ** np.indices(size).sum(axis=0)


def with_cube(value):
    v = air()
    v[2:6, 8:24, 8:24] = value
    return v


def measured(spark, arrays, shape=(8, 32, 32), **kw):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in np.ravel(np.array(v, object))]) for i, v in enumerate(arrays)]
    df = spark.createDataFrame(rows, "k int, v array<double>")
    return {r.k: r for r in volume_stats.volume_stats(df, "k", "v", shape, **kw).collect()}


def test_signal_and_noise(spark):
    got = measured(spark, [with_cube(100), with_cube(102)], spacing=F.array(F.lit(0.5), F.lit(1.0), F.lit(4.0)))
    a, b = got[0], got[1]
    assert a.background_noise_std == pytest.approx(1) and a.volume_tissue_pct == pytest.approx(12.5)
    assert a.volume_snr_estimate == pytest.approx(100, rel=1e-5) and a.volume_cnr == pytest.approx(98, rel=1e-5)
    assert 3 < a.otsu_threshold < 100 and a.volume_mean == pytest.approx(14.25)
    assert b.volume_snr_estimate == pytest.approx(102 / 1e-6)  # beyond 100 times the noise: against the tissue's own spread
    assert a.volume_shape == [8, 32, 32] and a.fov_mm == [32.0, 32.0, 16.0] and a.voxel_volume_mm3 == 2 and a.total_volume_cc == pytest.approx(16.384)
    assert a.origin_mm == [0.0, 0.0, 0.0] and a.direction_cosines == [] and len(a) == 38


def test_undefined_volumes(spark):
    got = measured(spark, [None, [1.0], [None] + [1.0] * 8191, [float("nan")] + [1.0] * 8191, np.full(8192, 5.0), np.zeros(8192)])
    assert all(got[i].volume_mean is None and got[i].volume_shape is None for i in range(4))
    assert got[4].volume_std == 0 and got[4].volume_skewness == 0 and got[4].volume_entropy == 0 and got[4].background_noise_std == pytest.approx(1e-6)
    assert got[5].volume_nonzero_pct == 0 and got[5].volume_snr_naive == 0
    assert volume_stats.volume_stats(spark.createDataFrame([], "k int, v array<double>"), "k", "v", (2, 2)).count() == 0


def test_noise_falls_back():
    bright = np.full((3, 16, 16), 50.0)
    bright[1, 0, :] = np.arange(16)  # corners too bright, and a tenth that reaches the common value holds all but the zero
    assert numpy_volume.background_noise(bright) == pytest.approx(np.std(bright[bright != 0]))
    ramp = np.arange(1.0, 1001.0).reshape(10, 10, 10)[:, ::-1]
    dark = np.sort(ramp.ravel())[:100]
    assert numpy_volume.background_noise(ramp) == pytest.approx(dark.std())


def test_image(spark):
    rows = [(0, [0.0] * 50 + [100.0] * 50), (1, []), (2, None), (3, [1.0, None])]
    got = {r.k: r for r in volume_stats.image_stats(spark.createDataFrame(rows, "k int, v array<double>"), "k", "v").collect()}
    r = got[0]
    assert (r.pixel_min, r.pixel_max, r.pixel_mean, r.pixel_std, r.pixel_median, r.pixel_p10, r.pixel_p90, r.pixel_iqr, r.nonzero_ratio, r.pixel_entropy, r.pixel_skewness) == (0, 100, 50, 50, 50, 0, 100, 100, 0.5, 1, 0)
    assert r.pixel_kurtosis == pytest.approx(-2) and r.histogram_counts == [50] + [0] * 48 + [50] and r.histogram_edges[::25] == [0, 50, 100]
    assert all(got[i].pixel_mean is None and got[i].histogram_counts is None for i in (1, 2, 3))


def test_mask(spark):
    df = spark.createDataFrame([([float(i) for i in range(101)],), ([5.0, 5.0],), ([],), (None,)], "v array<double>")
    got = [r.m for r in df.select(volume.tissue_mask(F.col("v")).alias("m")).collect()]
    assert [i for i, m in enumerate(got[0]) if m] == list(range(16, 99))
    assert got[1] == [False, False] and not got[2] and got[3] is None


def test_noise_and_peaks():
    assert numpy_volume.noise(air((4, 32, 32))) == (1.0, 1 / 1.526, "very low noise")
    assert [numpy_volume.noise(air((4, 32, 32)) * k)[2] for k in (5, 15, 30)] == ["low noise", "moderate noise", "high noise"]
    three = np.repeat([10.0, 50.0, 90.0], 400).reshape(3, 20, 20) + np.tile(np.linspace(-4, 4, 20), 60).reshape(3, 20, 20)
    n, apart, word = numpy_volume.histogram_peaks(three)
    assert n >= 3 and (word == "easy") == (apart > 0.1)
    assert numpy_volume.histogram_peaks(np.ones((2, 5, 5))) == (0, 0.0, "hard")


def test_small_volumes_are_neutral(spark):
    df = spark.createDataFrame([(0, air((4, 8, 8)).ravel().tolist())], "k int, v array<double>")
    r = volume.with_metrics(df, "k", "v", (4, 8, 8), small=10_000).first()
    assert (r.symmetry_index, r.symmetry, r.sharpness_mean, r.motion, r.motion_score) == (1.0, "N/A (small)", 0.0, False, 0.0)
