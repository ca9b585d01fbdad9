"""The chunked pyramid against numpy: levels, boxes, the files that a box opens, refused volumes."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from radspan.sources import pyramid


def lines(spark, volumes):
    rows = [(name, z, y, [float(x) for x in v[z, y]]) for name, v in volumes.items() for z in range(v.shape[0]) for y in range(v.shape[1])]
    return spark.createDataFrame(rows, "volume string, z int, y int, line array<double>")


def halved(v):
    padded = np.pad(v, [(0, n % 2) for n in v.shape])
    return padded.reshape(*itertools.chain(*((n // 2, 2) for n in padded.shape))).mean((1, 3, 5))


def gathered(rows, shape):
    out = np.full(shape, np.nan)
    for r in rows.collect():
        assert np.isnan(out[r.z, r.y, r.x : r.x + len(r.line)]).all()  # no voxel twice
        out[r.z, r.y, r.x : r.x + len(r.line)] = r.line
    return out


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = np.random.default_rng(0)
    volumes = {"a": rng.integers(0, 512, (9, 13, 17)).astype(float), "b": rng.integers(0, 512, (1, 1, 5)).astype(float), "c": np.zeros((2, 2, 2)), "d": np.arange(32 * 16 * 8).reshape(32, 16, 8) / 1.0}
    good = lines(spark, volumes)
    bad = spark.createDataFrame([("hole", 0, 0, [1.0]), ("hole", 2, 0, [1.0]), ("ragged", 0, 0, [1.0]), ("ragged", 0, 1, [1.0, 2.0]), ("twice", 0, 0, [1.0]), ("twice", 0, 0, [1.0]), ("empty", 0, 0, []), ("nan", 0, 0, [float("nan")]), ("null", 0, 0, None), (None, 0, 0, [1.0])], good.schema)
    path = f"{tmp_path_factory.mktemp('store')}/p"
    pyramid.write(lines(spark, {"old": np.zeros((3, 3, 3))}), path, 2)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        pyramid.write(good.unionByName(bad).withColumn("key", F.lit("clash")), path, 4, (2, 4, 8), (2.0, 1.5, 1.5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return path, volumes


def test_levels_are_means_and_sides_halve(spark, stored):
    path, volumes = stored
    told = {(r.volume, r.level): r for r in spark.read.parquet(f"{path}/levels").collect()}
    assert set(told) == {(n, k) for n in volumes for k in range(4)}  # nothing of the older store
    for name, v in volumes.items():
        want = v
        for level in range(4):
            r = told[name, level]
            assert (r.d, r.h, r.w) == want.shape and r["name"] == f"s{level}" and r.scale == [s * 2**level for s in (2.0, 1.5, 1.5)]
            assert r.chunk == [min(n, c) for n, c in zip(want.shape, (2, 4, 8), strict=True)] and r.n_bytes == want.size * 4
            assert gathered(pyramid.box(spark, path, name, level), want.shape) == pytest.approx(want, rel=1e-6)
            want = halved(want)


def test_boxes_are_cut_and_open_only_files_that_they_need(spark, stored):
    path, volumes = stored
    everything = spark.read.parquet(f"{path}/files").count()
    opened = []
    for low, high in [((0, 0, 0), (2, 4, 8)), ((3, 5, 7), (8, 13, 9)), ((4, 0, 0), (5, 13, 17)), ((-3, 12, 16), (99, 99, 99))]:
        rows = pyramid.box(spark, path, "a", 0, low, high)
        want = np.full(volumes["a"].shape, np.nan)
        cut = tuple(slice(max(0, lo), h) for lo, h in zip(low, high, strict=True))
        want[cut] = volumes["a"][cut]
        np.testing.assert_array_equal(gathered(rows, want.shape), want)
        opened.append(len(rows.inputFiles()))
    assert opened[0] == 1 and max(opened) < everything
    assert "PushedFilters: [" in pyramid.box(spark, path, "a")._jdf.queryExecution().executedPlan().toString()


def test_boxes_outside_and_unknown_volumes_and_levels_are_empty(spark, stored):
    path, _ = stored
    for args in [("a", 0, (9, 0, 0)), ("a", 0, (2, 2, 2), (2, 3, 3)), ("a", 4), ("hole", 0), ("x", 0)]:
        assert pyramid.box(spark, path, *args).count() == 0


def test_odd_volumes_are_refused_and_levels_checked(spark, stored):
    path, _ = stored
    assert {r.volume for r in spark.read.parquet(f"{path}/refused").collect()} == {"hole", "ragged", "twice", "empty", "nan", "null", None}
    with pytest.raises(ValueError, match="at least one level"):
        pyramid.write(lines(spark, {"a": np.zeros((1, 1, 1))}), path, 0)
    assert pyramid.box(spark, path, "c").count() == 4  # one line for each (z, y): a refused call leaves the store


def test_key_ranges_cover_a_box_and_little_more(spark):
    places = [(z, y, x) for z in range(8) for y in range(8) for x in range(8)]
    rows = spark.createDataFrame(places, "z int, y int, x int").select("*", pyramid.morton(F.col("z"), F.col("y"), F.col("x")).alias("k")).collect()
    keys = {(r.z, r.y, r.x): r.k for r in rows}
    assert sorted(keys.values()) == list(range(512))
    for low, high in [((0, 0, 0), (7, 7, 7)), ((3, 3, 3), (4, 4, 4)), ((5, 0, 0), (5, 7, 7)), ((1, 2, 3), (6, 5, 4))]:
        wanted = {keys[p] for p in places if all(a <= c <= b for a, c, b in zip(low, p, high, strict=True))}
        exact = pyramid.key_ranges(low, high, 10**6)
        assert {k for a, z in exact for k in range(a, z + 1)} == wanted
        rough = pyramid.key_ranges(low, high, 8)
        assert wanted <= {k for a, z in rough for k in range(a, z + 1)} and len(rough) <= 64
    far = (2**21 - 1, 0, 0)
    assert pyramid.key_ranges(far, far) and spark.range(1).select(pyramid.morton(*map(F.lit, far))).first()[0] == pyramid.key_ranges(far, far, 10**6)[0][0]


def test_an_empty_table_gives_an_empty_store(spark, tmp_path):
    pyramid.write(spark.createDataFrame([], "volume string, z int, y int, line array<double>"), f"{tmp_path}/e")
    assert pyramid.box(spark, f"{tmp_path}/e", "a").count() == 0
