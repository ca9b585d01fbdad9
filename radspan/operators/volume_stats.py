"""Summary statistics of volumes, over lines as in `slices`, and of single images: grouped aggregates, exact ranks, histograms
as counts by bin. No volume has to fit a row or a worker; those that do, of at most compact.MOST voxels, are rows of `compact`, as
a table of many small volumes would otherwise have several rows for each voxel in each step."""

from __future__ import annotations

from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.operators import compact, ranks, slices
from radspan.operators.slices import OTSU_BINS, beside_it
from radspan.sources.scratch import spread, work_table

#: percentiles of an image; a volume has those without 10 and 90
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
ARRAYS = ("volume_shape", "spacing_mm", "origin_mm", "direction_cosines", "fov_mm")
FIGURES = (
    "volume_voxel_count voxel_volume_mm3 total_volume_mm3 total_volume_cc volume_min volume_max volume_mean volume_std volume_median volume_p1 volume_p5 volume_p25 volume_p75 volume_p95 volume_p99 volume_iqr "
    "volume_dynamic_range volume_snr_estimate volume_snr_naive volume_cnr background_noise_std otsu_threshold volume_nonzero_pct volume_tissue_pct volume_entropy volume_skewness volume_kurtosis "
    "slice_snr_mean slice_snr_std slice_snr_min slice_snr_max slice_intensity_uniformity"
).split()
TINY, FLAT = 1e-6, 1e-10
# fixed values: air is darker than this share of the mean; slices looked at; corners; what is too bright to be noise
DARK, SAMPLED, CORNER, LEAST, BEYOND, CLASS = 0.3, 5, 8, 10, 100, 100


def piece_figures(pieces: DataFrame, bins: int, percentiles: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """The figures of value_figures for volumes as pieces (volume, line), in any order."""
    sizes = work_table(pieces.groupBy("volume").agg(F.sum(F.size("line")).alias("_n")), "sizes")
    large = sizes.where(F.col("_n") > compact.MOST).select("volume")
    if large.isEmpty():
        return _small_figures(pieces, bins, percentiles)
    beside = beside_it(large)  # at most a row for each MOST values
    rows = pieces.join(beside, "volume", "left_semi").select("volume", F.explode("line").alias("v"))
    found = value_figures(rows, bins, percentiles)[0]
    return found.unionByName(_small_figures(pieces.join(beside, "volume", "left_anti"), bins, percentiles).select(*found.columns))


def _small_figures(pieces: DataFrame, bins: int, percentiles: tuple[int, ...]) -> DataFrame:
    return compact.value_figures(compact.gathered(pieces), bins, percentiles, FLAT)


def value_figures(rows: DataFrame, bins: int, percentiles: tuple[int, ...] = PERCENTILES) -> tuple[DataFrame, DataFrame]:
    """Figures of the values (volume, v) of each volume, and its counts in OTSU_BINS bins (volume, low, width, bin, c).

    Figures: n, least, greatest, mean, std, skewness, kurtosis, nonzero, a column p<q> for each percentile, entropy over
    OTSU_BINS bins, counts and edges of `bins` equal bins (a constant volume is one unit wide around its value).
    """
    v = F.col("v")
    moments = [F.min(v).alias("least"), F.max(v).alias("greatest"), F.avg(v).alias("mean"), F.count_if(v != 0).alias("nonzero")]
    found = ranks.percentiles(rows, "volume", "v", {f"p{q}": q / 100 for q in percentiles}, moments)
    spread = F.col("greatest") > F.col("least")
    found = found.withColumns({"low": F.when(spread, F.col("least")).otherwise(F.col("least") - 0.5), "width": F.when(spread, F.col("greatest") - F.col("least")).otherwise(1.0)})
    found = work_table(found, "values")
    share, off = (v - F.col("low")) / F.col("width"), v - F.col("mean")
    place = lambda n: F.least(F.floor(share * n), F.lit(n - 1)).cast("int")
    cells = rows.join(beside_it(found.select("volume", "low", "width", "mean")), "volume").groupBy("volume", "low", "width", place(OTSU_BINS).alias("bin"), place(bins).alias("coarse"))
    cells = work_table(cells.agg(F.count("*").alias("c"), *[F.sum(F.pow(off, F.lit(k))).alias(f"d{k}") for k in (2, 3, 4)]), "cells")  # at most OTSU_BINS + bins rows a volume
    moment = lambda k: F.sum(f"d{k}") / F.sum("c")
    std = F.sqrt(moment(2))
    around = cells.groupBy("volume").agg(std.alias("std"), F.when(std < FLAT, 0.0).otherwise(F.try_divide(moment(3), F.pow(moment(2), F.lit(1.5)))).alias("skewness"), F.when(std < FLAT, 0.0).otherwise(F.try_divide(moment(4), moment(2) * moment(2)) - 3).alias("kurtosis"))
    found = found.join(around, "volume")
    fine = cells.groupBy("volume", "low", "width", "bin").agg(F.sum("c").alias("c"))
    p = F.col("c") / F.col("n")
    entropy = fine.join(found.select("volume", "n"), "volume").groupBy("volume").agg((-F.sum(p * F.log2(p))).alias("entropy"))
    coarse = cells.groupBy("volume", "coarse").agg(F.sum("c").alias("c")).groupBy("volume").agg(F.map_from_entries(F.collect_list(F.struct("coarse", "c"))).alias("_counts"))
    places = F.sequence(F.lit(0), F.lit(bins - 1))
    counts = F.transform(places, lambda i: F.coalesce(F.try_element_at("_counts", i), F.lit(0)).cast("long"))
    edges = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.col("low") + F.col("width") * i / bins)
    return found.join(entropy, "volume").join(coarse, "volume").withColumns({"counts": counts, "edges": edges}).drop("_counts", "low", "width"), fine


def _picked(d: Column) -> Column:
    """Up to SAMPLED slices, without those at the ends; of few slices the middle one."""
    edge = F.greatest(F.floor(d / 10), F.lit(1))
    most = F.least(F.lit(SAMPLED), d - 2 * edge)
    first, last = edge, d - edge - 1
    return F.when(d > 4, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(most - 1, F.lit(0)).cast("long")), lambda k: F.floor(first + (last - first) * k / F.greatest(most - 1, F.lit(1))))).otherwise(F.array(F.floor(d / 2)))


def _noise(at: DataFrame, figures: DataFrame) -> DataFrame:
    """volume, noise: the deviation of air, that is the median over up to five slices of their corners (an eighth of each side) where these
    are dark, else that of the darkest tenth, else that of all voxels; zeros are padding."""
    h, w = F.col("h"), F.col("w")
    ch, cw = F.greatest(F.floor(h / CORNER), F.lit(2)), F.greatest(F.floor(w / CORNER), F.lit(2))
    voxels = at.where(F.array_contains(_picked(F.col("d")), F.col("z").cast("long"))).select("volume", "z", "y", "h", "w", F.posexplode("line").alias("x", "v"))
    times = ((F.col("y") < ch).cast("int") + (F.col("y") >= h - ch).cast("int")) * ((F.col("x") < cw).cast("int") + (F.col("x") >= w - cw).cast("int"))  # corners may overlap
    corners = voxels.where("v <> 0").select("volume", "z", F.explode(F.array_repeat("v", times)).alias("v")).groupBy("volume", "z").agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
    mean = figures.select("volume", "mean", "std", "n")
    dark = corners.join(mean.drop("n"), "volume").where((F.col("n") > LEAST) & (F.col("m") < DARK * F.col("mean")))
    s = F.array_sort(F.collect_list("s"))  # one value a slice looked at
    k = F.size(s)
    middle = (F.get(s, F.floor((k - 1) / 2).cast("int")) + F.get(s, F.floor(k / 2).cast("int"))) / 2
    air = work_table(mean.join(dark.groupBy("volume").agg(middle.alias("air")), "volume", "left"), "air")
    open_ones = air.where((F.col("air").isNull() | (F.col("air") <= TINY)))
    rest = at.join(beside_it(open_ones.select("volume")), "volume", "left_semi").select("volume", F.explode("line").alias("v")).where("v <> 0")
    cut = work_table(ranks.percentiles(rest, "volume", "v", {"p": 0.1}).where(F.col("n") >= LEAST).select("volume", "p"), "cuts")
    low = rest.join(beside_it(cut), "volume").where("v <= p").groupBy("volume").agg(F.count("*").alias("k"), F.stddev_pop("v").alias("low")).where(F.col("k") > LEAST)
    good = lambda c: F.when(F.col(c) > TINY, F.col(c))
    return air.join(low.select("volume", "low"), "volume", "left").select("volume", F.coalesce(good("air"), good("low"), F.greatest("std", F.lit(TINY))).alias("noise"))


def line_stats(lines: DataFrame) -> DataFrame:
    """volume, d, h, w and the FIGURES that need no spacing, of volumes as lines (volume, z, y, line). Volumes that are not whole, or hold a
    null or non-finite voxel, have no row."""
    shapes = work_table(slices.shapes_of(lines).where("whole").select("volume", "d", "h", "w"), "shapes")
    doubles = lines.select("volume", "z", "y", F.transform("line", lambda x: x.cast("double")).alias("line"))
    is_large = F.col("d").cast("long") * F.col("h") * F.col("w") > compact.MOST
    large, at = shapes.where(is_large), lambda some: doubles.join(beside_it(some), "volume")
    found = _small_parts(compact.in_order(at(shapes.where(~is_large))))
    if not large.isEmpty():
        parts = _large_parts(at(large), large)
        found = parts.unionByName(found.select(*parts.columns))
    return _signal(found)


def _small_parts(arrays: DataFrame) -> DataFrame:
    return compact.stats(arrays, PERCENTILES, _picked, CORNER, {"tiny": TINY, "flat": FLAT, "dark": DARK, "least": LEAST})


def _large_parts(at: DataFrame, shapes: DataFrame) -> DataFrame:
    """What the figures are made of, from lines beside the shapes of their volumes."""
    rows = at.select("volume", F.explode("line").alias("v"))
    figures, bins = value_figures(rows, OTSU_BINS)
    figures = work_table(figures.drop("counts", "edges"), "figures")
    cut = work_table(slices.thresholds(bins), "thresholds")
    v = F.col("v")
    tissue, below = F.when(v > F.col("threshold"), v), F.when((v <= F.col("threshold")) & (v > 0), v)
    classes = rows.join(beside_it(cut), "volume").groupBy("volume", "threshold").agg(F.count(tissue).alias("n1"), F.avg(tissue).alias("m1"), F.stddev_pop(tissue).alias("s1"), F.count(below).alias("n0"), F.avg(below).alias("m0"))
    by_slice = at.select("volume", "z", F.explode("line").alias("v")).groupBy("volume", "z").agg(F.avg("v").alias("a"), F.stddev_pop("v").alias("s"))
    r, a = F.col("a") / (F.col("s") + TINY), F.col("a")
    levels = by_slice.groupBy("volume").agg(F.avg(r).alias("slice_snr_mean"), F.stddev_pop(r).alias("slice_snr_std"), F.min(r).alias("slice_snr_min"), F.max(r).alias("slice_snr_max"), F.stddev_pop(a).alias("_sa"), F.avg(a).alias("_ma"))
    parts = [figures, classes, levels, _noise(at, figures)]
    return reduce(lambda x, y: x.join(y, "volume", "left"), parts, shapes)


def _signal(out: DataFrame) -> DataFrame:
    """volume, d, h, w and the FIGURES that need no spacing."""
    signal, noise = F.when(F.col("n1") > 0, F.col("m1")).otherwise(F.col("mean")), F.col("noise") + TINY
    plain = signal / noise
    snr = F.when(plain > BEYOND, signal / (F.when(F.col("n1") > CLASS, F.col("s1")).otherwise(F.col("std")) + TINY)).otherwise(plain)
    made = {
        "volume_voxel_count": F.col("n"), "volume_min": F.col("least"), "volume_max": F.col("greatest"), "volume_mean": F.col("mean"), "volume_std": F.col("std"), "volume_median": F.col("p50"),
        **{f"volume_p{q}": F.col(f"p{q}") for q in (1, 5, 25, 75, 95, 99)},
        "volume_iqr": F.col("p75") - F.col("p25"), "volume_dynamic_range": F.col("greatest") - F.col("least"), "volume_snr_estimate": snr, "volume_snr_naive": F.col("mean") / (F.col("std") + TINY),
        "volume_cnr": F.when(F.col("n0") > CLASS, F.abs(signal - F.col("m0")) / noise).otherwise(snr), "background_noise_std": F.col("noise"), "otsu_threshold": F.col("threshold"),
        "volume_nonzero_pct": F.col("nonzero") / F.col("n") * 100, "volume_tissue_pct": F.col("n1") / F.col("n") * 100, "volume_entropy": F.col("entropy"), "volume_skewness": F.col("skewness"), "volume_kurtosis": F.col("kurtosis"),
        **{f"slice_snr_{x}": F.col(f"slice_snr_{x}") for x in ("mean", "std", "min", "max")}, "slice_intensity_uniformity": 1 - F.col("_sa") / (F.col("_ma") + TINY),
    }
    return out.select("volume", "d", "h", "w", *[c.alias(n) for n, c in made.items()])


def sized_stats(found: DataFrame, spacing: Column, images: bool = False) -> DataFrame:
    """found (of line_stats) with shape, spacing, field of view and the sizes in mm; spacing is x, y, z in mm, 1 where it is missing."""
    step = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.coalesce(F.get(spacing, i), F.lit(1.0)))
    size = F.get(step, F.lit(0)) * F.get(step, F.lit(1)) * F.get(step, F.lit(2))
    shape = F.array(*[F.col(c).cast("long") for c in ("h" if images else "d", "w" if images else "h", *([] if images else ["w"]))])
    whole = F.col("d").isNotNull()
    only = lambda c: F.when(whole, c)
    fov = F.transform(shape, lambda n, i: n * F.get(F.reverse(step), i))
    n = F.col("volume_voxel_count")
    return found.withColumns({"volume_shape": only(shape), "spacing_mm": only(step), "fov_mm": only(fov), "voxel_volume_mm3": only(size), "total_volume_mm3": size * n, "total_volume_cc": size * n / 1000})


def _array_stats(df: DataFrame, key: str, values: str, shape: tuple[int, ...]) -> DataFrame:
    """line_stats of arrays: small ones are rows already. A key of several arrays of the right size is no whole volume."""
    size = prod(shape)
    if size > compact.MOST:
        return line_stats(slices.lines_of(df, key, values, shape))
    arrays = df.where(F.size(values) == size).select(F.col(key).alias("volume"), F.transform(values, lambda x: x.cast("double")).alias("values"))
    arrays = spread(arrays, "volume").groupBy("volume").agg(F.count("*").alias("_k"), F.first("values").alias("values"))
    odd = F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sides = [F.lit(n).alias(c) for c, n in zip("dhw", (1, *shape)[-3:], strict=True)]
    return _signal(_small_parts(arrays.where((F.col("_k") == 1) & ~odd).select("volume", *sides, "values")))


def volume_stats(df: DataFrame, key: str, values: str, shape: tuple[int, ...], spacing: Column | None = None, origin: Column | None = None, direction: Column | None = None) -> DataFrame:
    """key and the 37 statistics of each volume that is one array a row (values in row order).

    Arrays of another size, null arrays, and arrays with a null or non-finite voxel give nulls. Without an origin it is 0,
    without a direction an empty array.
    """
    given = df.select(F.col(key).alias("volume"), *[(F.lit(None) if c is None else c).cast("array<double>").alias(n) for n, c in (("_s", spacing), ("_o", origin), ("_d", direction))])
    found = given.join(_array_stats(df, key, values, shape), "volume", "left")
    found = sized_stats(found, F.col("_s"), images=len(shape) < 3)
    whole = F.col("d").isNotNull()
    found = found.withColumn("origin_mm", F.when(whole, F.coalesce("_o", F.array(*[F.lit(0.0)] * len(shape))))).withColumn("direction_cosines", F.when(whole, F.coalesce("_d", F.array().cast("array<double>"))))
    return found.select(F.col("volume").alias(key), *ARRAYS, *FIGURES)


def image_stats(df: DataFrame, key: str, values: str, bins: int = 50) -> DataFrame:
    """key and the figures of each image: extremes, moments, nine percentiles, iqr, share of non-zeros, entropy, histogram
    counts and edges. Null and empty arrays, and those with a null or non-finite value, give nulls."""
    v = F.transform(values, lambda x: x.cast("double"))
    good = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = piece_figures(df.select(F.col(key).alias("volume"), v.alias("line")).where(F.coalesce(good, F.lit(False))), bins)
    names = {"min": "least", "max": "greatest", "mean": "mean", "std": "std", "median": "p50", **{f"p{q}": f"p{q}" for q in PERCENTILES}}
    out = found.select("volume", *[F.col(c).alias(f"pixel_{n}") for n, c in names.items()], (F.col("p75") - F.col("p25")).alias("pixel_iqr"), (F.col("nonzero") / F.col("n")).alias("nonzero_ratio"), *[F.col(c).alias(f"pixel_{c}") for c in ("entropy", "skewness", "kurtosis")], F.col("counts").alias("histogram_counts"), F.col("edges").alias("histogram_edges"))
    return df.select(F.col(key).alias("volume")).join(out, "volume", "left").withColumnRenamed("volume", key)


def histograms(lines: DataFrame, bins: int = 200, percentiles: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """volume, n, counts and edges of equal bins, and percentiles with interpolation; the last bin holds the greatest value."""
    found = piece_figures(lines.select("volume", F.transform("line", lambda x: x.cast("double")).alias("line")), bins, percentiles)
    return found.select("volume", "n", "counts", "edges", *[f"p{q}" for q in percentiles])
