"""Figures over lines against numpy over whole volumes."""

import numpy as np
import numpy_volume
import pytest

from radspan.operators import slices


def _volumes():
    rng = np.random.default_rng(8)
    smooth = np.cumsum(np.cumsum(rng.random((9, 24, 28)), axis=1), axis=2)
    out = {
        "plain": rng.random((6, 25, 31)) * 100 + 1,
        "smooth": smooth,
        "many": np.repeat(rng.random((45, 1, 1)), 22, axis=1).repeat(21, axis=2) * rng.random((45, 22, 21)) * 50,
        "zeros": np.zeros((4, 21, 22)),
        "flat": np.full((4, 21, 22), 7.0),
        "sparse": np.where(rng.random((5, 22, 23)) < 0.1, rng.random((5, 22, 23)) * 90, 0),
        "dark corners": np.pad(rng.random((5, 20, 20)) * 40 + 60, ((0, 0), (6, 6), (6, 6))),
        "negative": rng.normal(size=(5, 20, 24)) * 30,
        "one slice": rng.random((1, 20, 22)) * 80,
        "two slices": rng.random((2, 20, 22)) * 80,
        "tiny": rng.random((3, 2, 3)) * 80,
    }
    mirrored = rng.random((4, 20, 11)) * 100
    out["mirrored"] = np.concatenate([mirrored, mirrored[..., ::-1]], axis=-1)
    return out


NAMES = [x.split()[0] for x in numpy_volume.METRICS.split(", ")]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, z, y, v[z, y].tolist()) for k, v in _volumes().items() for z in range(v.shape[0]) for y in range(v.shape[1])]
    more = [("missing", 0, 1, [1.0, 2.0]), ("twice", 0, 0, [1.0]), ("twice", 0, 0, [1.0]), ("ragged", 0, 0, [1.0, 2.0]), ("ragged", 0, 1, [1.0]), ("null", 0, 0, [1.0, None]), ("nan", 0, 0, [float("nan")]), ("inf", 0, 0, [float("inf")])]
    lines = spark.createDataFrame(rows + more, "volume string, z int, y int, line array<double>").repartition(3)
    return {r.volume: r for r in slices.metrics(lines).collect()}


@pytest.mark.parametrize("name", list(_volumes()))
def test_figures_are_those_of_whole_volumes(found, name):
    v, got = _volumes()[name], found[name]
    want = dict(zip(NAMES, numpy_volume.measure(v), strict=True))
    if name == "tiny":  # numpy's mean of nothing
        want = {k: x for k, x in want.items() if not k.startswith("sharpness")}
    for k, x in want.items():
        assert got[k] == (pytest.approx(x, rel=1e-6, abs=1e-6) if isinstance(x, float) else x), k


def test_volumes_that_are_not_whole_have_nulls(found):
    for name in ("missing", "twice", "ragged", "null", "nan", "inf"):
        assert all(found[name][f] is None for f in slices.FIGURES)


def test_images_descriptions_and_small_volumes(spark):
    image = np.random.default_rng(3).random((20, 24)) * 60
    df = spark.createDataFrame([("a", image.ravel().tolist())], "k string, v array<double>")
    lines = slices.lines_of(df, "k", "v", (20, 24))
    r = slices.metrics(lines, images=True).first()
    want = dict(zip(NAMES, numpy_volume.measure(image), strict=True))
    assert (r.symmetry, r.noise_floor, r.bias_severity, r.mean_correlation) == ("N/A (2D)", 0.0, 0.0, 1.0)
    assert all(r[k] == pytest.approx(want[k]) for k in ("sharpness_mean", "sharpness_p95", "ghosting_ratio", "laplacian_variance", "cnr"))
    cube = spark.createDataFrame([(i, t, (np.random.default_rng(i).random((4, 6, 6)) * 9).ravel().tolist()) for i, t in enumerate(("Sag T2", "cor", "Ax", None))], "k int, t string, v array<double>")
    told = {r.volume: r.symmetry for r in slices.metrics(slices.lines_of(cube, "k", "v", (4, 6, 6)), descriptions=cube.selectExpr("k as volume", "t as description")).collect()}
    assert told[0] == told[1] == "N/A (non-axial)" and "N/A" not in told[2] + told[3]
    small = slices.metrics(slices.lines_of(cube, "k", "v", (4, 6, 6)), small=144).first()
    assert {k: small[k] for k in slices.NEUTRAL} == slices.NEUTRAL and small.laplacian_variance > 0


def test_statistics_are_those_of_whole_volumes(spark):
    """line_stats against numpy, over the same volumes."""
    from radspan.operators import volume_stats

    rows = [(k, z, y, v[z, y].tolist()) for k, v in _volumes().items() for z in range(v.shape[0]) for y in range(v.shape[1])]
    got = {r.volume: r for r in volume_stats.line_stats(spark.createDataFrame(rows, "volume string, z int, y int, line array<double>").repartition(3)).collect()}
    for k, v in _volumes().items():
        want = numpy_volume.stats(v)
        for f in volume_stats.FIGURES:
            if f in got[k].asDict():
                assert got[k][f] == pytest.approx(float(want[f]), rel=1e-6, abs=1e-6), (k, f)
