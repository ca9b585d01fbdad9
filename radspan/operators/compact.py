"""Figures of volumes that are small enough to be one row: the voxels are an array, sorted once, and each figure is an expression
over it. No voxel becomes a row; what is shuffled is each array, once. Volumes of more than MOST voxels are left to `volume_stats`,
whose figures these are.

What a lambda takes from outside is an array column or is bound first, so that nothing is computed again for each element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.operators.slices import OTSU_BINS
from radspan.operators.volume import bound
from radspan.sources.scratch import spread

#: Voxels of a volume that is one row, 512 KB.
MOST = 65_536


def gathered(pieces: DataFrame) -> DataFrame:
    """volume, values: all values of the pieces (volume, line) of a volume that are numbers, in any order."""
    numbers = F.filter("line", lambda x: x.isNotNull() & ~F.isnan(x))
    found = spread(pieces.where("volume IS NOT NULL"), "volume").groupBy("volume").agg(F.flatten(F.collect_list(numbers)).alias("values"))
    return found.where(F.size("values") > 0)


def in_order(lines: DataFrame) -> DataFrame:
    """volume, d, h, w, values (z, y, x in row order) of lines (volume, d, h, w, z, y, line) of whole volumes."""
    found = spread(lines, "volume").groupBy("volume", "d", "h", "w").agg(F.sort_array(F.collect_list(F.struct("z", "y", "line"))).alias("_lines"))
    return found.select("volume", "d", "h", "w", F.flatten(F.transform("_lines", lambda x: x["line"])).alias("values"))


def _sum(values: Column | str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _level(values: Column) -> Column:
    """n, m, s: number, mean and deviation; the last two are null without a value."""
    deviation = lambda v, m: F.sqrt(F.try_divide(_sum(F.transform(v, lambda x: (x - m) * (x - m))), F.size(v)))
    return bound(values, lambda v: bound(F.try_divide(_sum(v), F.size(v)), lambda m: F.struct(F.size(v).cast("long").alias("n"), m.alias("m"), deviation(v, m).alias("s"))))


def _percentile(ordered: Column, q: float) -> Column:
    """Linear interpolation between neighbours, as in `ranks.percentiles`."""
    at = F.lit(q) * (F.size(ordered) - 1)
    a, b = F.get(ordered, F.floor(at).cast("int")), F.get(ordered, F.ceil(at).cast("int"))
    return F.when(a == b, a).otherwise(a + (b - a) * (at - F.floor(at)))


def _with_runs(df: DataFrame, bins: int, name: str) -> DataFrame:
    """df with the bins that have values, in order: an array of (bin, c)."""
    share = F.struct(F.col("low").alias("low"), F.col("width").alias("width"))
    places = bound(share, lambda p: F.transform("ordered", lambda x: F.least(F.floor((x - p["low"]) / p["width"] * bins), F.lit(bins - 1)).cast("int")))
    df = df.withColumn("_places", places)
    df = df.withColumn("_starts", F.filter(F.sequence(F.lit(0), F.size("_places") - 1), lambda i: (i == 0) | (F.get("_places", i) != F.get("_places", i - 1))))
    run = lambda at, k: F.struct(F.get("_places", at).alias("bin"), (F.coalesce(F.get("_starts", k + 1), F.size("_places")) - at).cast("long").alias("c"))
    return df.withColumn(name, F.transform("_starts", run)).drop("_places", "_starts")


def value_figures(arrays: DataFrame, bins: int | None, percentiles: tuple[int, ...], flat: float) -> DataFrame:
    """arrays (values, no null or NaN, not empty) with the figures of `volume_stats.value_figures`, ordered, low, width and runs
    (of OTSU_BINS); counts and edges unless bins is None."""
    found = arrays.withColumns({"ordered": F.sort_array("values"), "n": F.size("values").cast("long")})
    s = F.col("ordered")
    found = found.withColumns({"least": F.get(s, F.lit(0)), "greatest": F.element_at(s, -1), "mean": _sum("values") / F.col("n"), "nonzero": F.size(F.filter("values", lambda x: x != 0)).cast("long"), **{f"p{q}": _percentile(s, q / 100) for q in percentiles}})
    apart = F.col("greatest") > F.col("least")
    found = found.withColumns({"low": F.when(apart, F.col("least")).otherwise(F.col("least") - 0.5), "width": F.when(apart, F.col("greatest") - F.col("least")).otherwise(1.0)})
    off = lambda a, d: F.struct(*[(a[f"d{k}"] + p).alias(f"d{k}") for k, p in ((2, d * d), (3, d * d * d), (4, d * d * d * d))])
    none = F.struct(*[F.lit(0.0).alias(f"d{k}") for k in (2, 3, 4)])
    found = found.withColumn("_d", bound(F.col("mean"), lambda m: F.aggregate("values", none, lambda a, x: bound(x - m, lambda d: off(a, d)))))
    m2, m3, m4 = (F.col(f"_d.d{k}") / F.col("n") for k in (2, 3, 4))
    found = found.withColumn("std", F.sqrt(m2))
    still = F.col("std") < flat
    found = found.withColumns({"skewness": F.when(still, 0.0).otherwise(F.try_divide(m3, F.pow(m2, F.lit(1.5)))), "kurtosis": F.when(still, 0.0).otherwise(F.try_divide(m4, m2 * m2) - 3)}).drop("_d")
    found = _with_runs(found, OTSU_BINS, "runs")
    found = found.withColumn("entropy", bound(F.col("n"), lambda n: -F.aggregate(F.transform("runs", lambda r: r["c"] / n), F.lit(0.0), lambda a, p: a + p * F.log2(p))))
    if bins is None:
        return found
    found = _with_runs(found, bins, "_coarse").withColumn("_counts", F.map_from_entries("_coarse"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.try_element_at("_counts", i), F.lit(0)).cast("long"))
    edges = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.col("low") + F.col("width") * i / bins)
    return found.withColumns({"counts": counts, "edges": edges}).drop("_coarse", "_counts")


def _threshold() -> Column:
    """The centre of the first bin of largest variance between the classes, of runs, low, width and n; as `slices.thresholds`."""
    given = F.struct(F.col("low").alias("low"), F.col("width").alias("width"), F.col("n").alias("n"))
    centre = lambda g, r: g["low"] + g["width"] * (r["bin"] + 0.5) / OTSU_BINS
    start = F.struct(F.lit(0).cast("long").alias("w0"), F.lit(0.0).alias("s0"), F.lit(-1.0).alias("best"), F.lit(None).cast("double").alias("at"))

    def between(t: Column, n: Column, total: Column) -> Column:
        w1 = n - t["w0"]
        return F.round(F.when(w1 > 0, t["w0"] * w1 * F.pow(t["s0"] / t["w0"] - (total - t["s0"]) / w1, F.lit(2.0))).otherwise(0.0), 6)

    def step(g: Column, total: Column, a: Column, r: Column) -> Column:
        kept = lambda t, b: F.struct(t["w0"].alias("w0"), t["s0"].alias("s0"), F.greatest(b, a["best"]).alias("best"), F.when(b > a["best"], t["ce"]).otherwise(a["at"]).alias("at"))
        taken = bound(centre(g, r), lambda ce: F.struct((a["w0"] + r["c"]).alias("w0"), (a["s0"] + r["c"] * ce).alias("s0"), ce.alias("ce")))
        return bound(taken, lambda t: bound(between(t, g["n"], total), lambda b: kept(t, b)))

    total = lambda g: F.aggregate("runs", F.lit(0.0), lambda a, r: a + r["c"] * centre(g, r))
    first = F.col("low") + F.col("width") * 0.5 / OTSU_BINS  # of a constant volume
    return F.when(F.size("runs") > 1, bound(given, lambda g: bound(total(g), lambda s: F.aggregate("runs", start, lambda a, r: step(g, s, a, r), lambda a: a["at"])))).otherwise(first)


def stats(arrays: DataFrame, percentiles: tuple[int, ...], picked: Callable[[Column], Column], corner: int, fixed: dict[str, float]) -> DataFrame:
    """What `volume_stats.line_stats` makes its figures of, for arrays (volume, d, h, w, values in row order) of whole volumes.

    picked: the slices looked at for air, of d; corner: sides of a slice over sides of its corners; fixed: thresholds by name.
    """
    tiny = fixed["tiny"]
    found = value_figures(arrays, None, percentiles, fixed["flat"]).withColumn("threshold", _threshold())
    s, size = F.col("ordered"), F.struct(F.col("h").alias("h"), F.col("w").alias("w"))
    tissue = bound(F.col("threshold"), lambda t: _level(F.filter(s, lambda x: x > t)))
    below = bound(F.col("threshold"), lambda t: _level(F.filter(s, lambda x: (x <= t) & (x > 0))))
    levels = bound(size, lambda g: F.transform(F.sequence(F.lit(0), F.col("d").cast("int") - 1), lambda z: _level(F.slice("values", (z * g["h"] * g["w"] + 1).cast("int"), (g["h"] * g["w"]).cast("int")))))
    side = lambda n: bound(F.greatest(F.floor(n / corner), F.lit(2)), lambda c: F.concat(F.filter(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: i < c), F.filter(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: i >= n - c)))  # noqa: E731  both ends, which may overlap
    ends = F.struct(F.col("h").alias("h"), F.col("w").alias("w"), side(F.col("h")).alias("y"), side(F.col("w")).alias("x"))
    inside = lambda g, z: F.flatten(F.transform(g["y"], lambda y: F.transform(g["x"], lambda x: F.get("values", ((z * g["h"] + y) * g["w"] + x).cast("int")))))
    corners = bound(ends, lambda g: F.transform(picked(F.col("d")), lambda z: _level(F.filter(inside(g, z), lambda v: v != 0))))
    found = found.withColumns({"_t": tissue, "_b": below, "_l": levels, "_c": corners})
    dark = bound(F.col("mean"), lambda m: F.sort_array(F.transform(F.filter("_c", lambda c: (c["n"] > fixed["least"]) & (c["m"] < fixed["dark"] * m)), lambda c: c["s"])))
    middle = lambda a: (F.get(a, F.floor((F.size(a) - 1) / 2).cast("int")) + F.get(a, F.floor(F.size(a) / 2).cast("int"))) / 2
    r, a = F.transform("_l", lambda x: x["m"] / (x["s"] + tiny)), F.transform("_l", lambda x: x["m"])
    found = found.withColumns({"air": bound(dark, middle), "_r": r, "_a": a})
    lowest = bound(F.filter(s, lambda x: x != 0), lambda v: F.when(F.size(v) >= fixed["least"], bound(_percentile(v, 0.1), lambda p: _level(F.filter(v, lambda x: x <= p)))))
    low = bound(lowest, lambda k: F.when(k["n"] > fixed["least"], k["s"]))
    good = lambda c: F.when(c > tiny, c)
    noise = F.coalesce(good(F.col("air")), bound(low, good), F.greatest("std", F.lit(tiny)))
    found = found.withColumns({"noise": noise, "_rl": _level(F.col("_r")), "_al": _level(F.col("_a"))})
    names = {"n1": "_t.n", "m1": "_t.m", "s1": "_t.s", "n0": "_b.n", "m0": "_b.m", "slice_snr_mean": "_rl.m", "slice_snr_std": "_rl.s", "_sa": "_al.s", "_ma": "_al.m"}
    return found.withColumns({**{k: F.col(c) for k, c in names.items()}, "slice_snr_min": F.array_min("_r"), "slice_snr_max": F.array_max("_r")}).drop("values", "ordered", "runs", "low", "width", "_t", "_b", "_l", "_c", "_r", "_a", "_rl", "_al", "air")
