"""Quality of whole volumes from their lines: one row per image line (volume, z, y, line), so that no volume and no batch of
slices has to fit a row or a worker.

Every figure is a grouped aggregate. What looks at neighbours gets them by a halo: a line goes to the lines, or pairs of
slices, that need it, and the group puts them side by side. Histograms are counts per (volume, bin); exact percentiles
are those of `ranks`. Only the spectrum of the middle slice is a transform of that one slice in an Arrow batch.

Defined cases: a volume with a missing or repeated line, lines of different lengths, or a null, NaN or infinite voxel has
nulls in all figures; the histogram is smoothed in whole
numbers, so equal neighbours are no peak; a volume of fewer than three slices has neutral symmetry, bias and consistency; too few positive voxels give 0.
The lines are read once for each kind of figure: hand in a table, not a long computation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.operators import ranks
from radspan.sources.scratch import work_table

# fixed values: thresholds and words of the figures
NOT_AXIAL = ("SAG", "COR")
SYMMETRY = ((0.90, "symmetric"), (0.80, "normal"), (0.65, "mild asymmetry"))
NOISE = ((5, "very low noise"), (15, "low noise"), (30, "moderate noise"))
RICIAN = 1.526  # the noise floor of magnitude images in units of its sigma
LEAST_VOXELS, LEAST_CLASS, LEAST_CORNER, LEAST_CELL, GRID = 100, 10, 20, 10, 4
OTSU_BINS, PEAK_BINS, PEAK_SHARE = 256, 128, 20
SAMPLED_SLICES, SAMPLED_PAIRS = 5, 20
#: Tables with a row for each volume are broadcast up to so many rows.
BROADCAST_ROWS = 100_000
#: What stands for symmetry, sharpness and motion of volumes that are too small to tell.
NEUTRAL = {"symmetry_index": 1.0, "symmetry": "N/A (small)", "asymmetry_mean": 0.0, "sharpness_mean": 0.0, "sharpness_std": 0.0, "sharpness_p95": 0.0, "ghosting_ratio": 1.0, "slice_correlation": 1.0, "motion": False, "motion_score": 0.0}
FIGURES = (
    "symmetry_index symmetry asymmetry_mean sharpness_mean sharpness_std sharpness_p95 ghosting_ratio slice_correlation motion motion_score cnr threshold noise_floor rician_sigma noise bias_severity n_patches laplacian_variance "
    "n_peaks min_peak_separation segmentation mean_correlation min_correlation std_correlation n_pairs"
).split()


def lines_of(df: DataFrame, key: str, values: str, shape: tuple[int, ...]) -> DataFrame:
    """Lines of volumes that are one array a row (z, y, x in row order, or y, x); arrays of another size have none."""
    depth, height, width = (1, *shape)[-3:]
    v = F.transform(values, lambda x: x.cast("double"))
    cut = F.transform(F.sequence(F.lit(0), F.lit(depth * height - 1)), lambda i: F.slice(v, i * width + 1, F.lit(width)))
    rows = df.where(F.size(values) == depth * height * width).select(F.col(key).alias("volume"), F.posexplode(cut).alias("at", "line"))
    return rows.select("volume", F.floor(F.col("at") / height).cast("int").alias("z"), (F.col("at") % height).alias("y"), "line")


def beside_it(table: DataFrame) -> DataFrame:
    """A table with a row for each volume, a work table: broadcast if that is few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def shapes_of(lines: DataFrame) -> DataFrame:
    """d, h, w and the positive voxels (n_pos, low, high) of each volume; whole: nothing is missing, doubled or no number."""
    v = F.col("v")
    rows = lines.select("volume", "z", "y", F.size("line").alias("w"), F.explode("line").alias("v"))
    found = rows.groupBy("volume").agg(
        (F.max("z") + 1).alias("d"), (F.max("y") + 1).alias("h"), F.max("w").alias("w"), F.min("w").alias("_w"), F.min("z").alias("_z"), F.min("y").alias("_y"), F.count("*").alias("n"),
        F.count_if(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))).alias("_odd"), F.count_if(v > 0).alias("n_pos"), F.min(F.when(v > 0, v)).alias("low"), F.max(F.when(v > 0, v)).alias("high"),
    )
    distinct = lines.select("volume", "z", "y").distinct().groupBy("volume").agg(F.count("*").alias("_lines"))
    found = found.join(distinct, "volume")
    whole = (F.col("n") == F.col("d").cast("long") * F.col("h") * F.col("w")) & (F.col("_lines") == F.col("d").cast("long") * F.col("h")) & (F.col("_w") == F.col("w")) & (F.col("_z") >= 0) & (F.col("_y") >= 0) & (F.col("_odd") == 0)
    spread = F.col("high") > F.col("low")
    low, width = F.when(spread, F.col("low")).otherwise(F.col("low") - 0.5), F.when(spread, F.col("high") - F.col("low")).otherwise(1.0)
    return found.select("volume", "d", "h", "w", "n", "n_pos", low.alias("low"), width.alias("width"), whole.alias("whole"))


def _symmetry(at: DataFrame) -> DataFrame:
    """Correlation and mean relative difference of the left half and the mirrored right half."""
    half = F.floor(F.col("w") / 2).cast("int")
    pairs = at.where("d >= 3 AND w >= 2").select("volume", F.explode(F.arrays_zip(F.slice("line", F.lit(1), half).alias("a"), F.slice(F.reverse("line"), F.lit(1), half).alias("b"))).alias("p")).select("volume", "p.*")
    got = pairs.groupBy("volume").agg(F.covar_pop("a", "b").alias("c"), F.stddev_pop("a").alias("sa"), F.stddev_pop("b").alias("sb"), F.count("*").alias("m"), F.avg(F.try_divide(F.abs(F.col("a") - F.col("b")), (F.col("a") + F.col("b")) / 2 + 1e-6)).alias("asym"))
    return got.select("volume", F.when(F.col("m") * F.col("sa") * F.col("sb") > 1e-12, F.col("c") / (F.col("sa") * F.col("sb"))).otherwise(0.0).alias("_r"), F.col("asym").alias("_asym"))


def _pairs(at: DataFrame) -> DataFrame:
    """Correlations of neighbouring slices: of up to SAMPLED_PAIRS pairs, and of the middle one with the next."""
    step, mid = F.greatest(F.floor(F.col("d") / SAMPLED_PAIRS), F.lit(1)), F.floor(F.col("d") / 2)
    sampled = (F.col("pair") % step == 0) & (F.col("pair") < step * SAMPLED_PAIRS)
    sent = at.where("d >= 3").select("volume", "d", "y", "line", F.explode(F.array(F.struct(F.col("z").alias("pair"), F.lit(0).alias("second")), F.struct((F.col("z") - 1).alias("pair"), F.lit(1).alias("second")))).alias("t"))
    sent = sent.select("volume", "d", "y", "line", "t.*").where((F.col("pair") >= 0) & (F.col("pair") < F.col("d") - 1) & (sampled | (F.col("pair") == mid)))
    side = lambda k: F.max(F.when(F.col("second") == k, F.col("line")))
    both = sent.groupBy("volume", "d", "pair", "y").agg(side(0).alias("a"), side(1).alias("b"))
    both = both.select("volume", "d", "pair", F.explode(F.arrays_zip("a", "b")).alias("p"))
    got = both.groupBy("volume", "d", "pair").agg(F.covar_pop("p.a", "p.b").alias("c"), F.stddev_pop("p.a").alias("sa"), F.stddev_pop("p.b").alias("sb")).where("sa > 1e-6 AND sb > 1e-6")
    got = got.withColumn("r", F.try_divide("c", F.col("sa") * F.col("sb")))
    r = F.when(sampled, F.col("r"))
    return got.groupBy("volume").agg(F.avg(r).alias("mean_correlation"), F.min(r).alias("min_correlation"), F.stddev_pop(r).alias("std_correlation"), F.count(r).cast("int").alias("n_pairs"), F.max(F.when(F.col("pair") == mid, F.col("r"))).alias("_near"))


def thresholds(bins: DataFrame) -> DataFrame:
    """The centre of the first bin with the largest variance between the two classes; bins: volume, low, width, bin, c (those with values)."""
    centre = F.col("low") + F.col("width") * (F.col("bin") + 0.5) / OTSU_BINS
    run = Window.partitionBy("volume").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("volume")
    otsu = bins.withColumn("centre", centre).withColumns({"w0": F.sum("c").over(run), "s0": F.sum(F.col("c") * F.col("centre")).over(run), "w": F.sum("c").over(whole), "s": F.sum(F.col("c") * F.col("centre")).over(whole)})
    w1 = F.col("w") - F.col("w0")
    between = F.when(w1 > 0, F.col("w0") * w1 * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1, F.lit(2.0))).otherwise(0.0)
    first = F.min("low") + F.min("width") * 0.5 / OTSU_BINS  # of a constant volume
    return otsu.groupBy("volume").agg(F.when(F.count("*") > 1, F.max_by("centre", F.struct(F.round(between, 6), -F.col("bin")))).otherwise(first).alias("threshold"))


def _histograms(at: DataFrame, beside: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The threshold of largest variance between two classes of positive voxels, and the peaks of their smoothed histogram."""
    place = F.least(F.floor((F.col("v") - F.col("low")) / F.col("width") * OTSU_BINS), F.lit(OTSU_BINS - 1)).cast("int")
    rows = at.where(F.col("n_pos") >= LEAST_VOXELS).select("volume", "low", "width", F.explode("line").alias("v")).where("v > 0")
    bins = work_table(rows.groupBy("volume", "low", "width", place.alias("bin")).agg(F.count("*").alias("c")), "bins")  # at most OTSU_BINS rows a volume
    otsu, whole = thresholds(bins), Window.partitionBy("volume")
    counts = bins.groupBy("volume", "width", "low", F.floor(F.col("bin") * PEAK_BINS / OTSU_BINS).alias("bin")).agg(F.sum("c").alias("c"))
    grid = beside.where(F.col("n_pos") >= LEAST_VOXELS).select("volume", "low", "width", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PEAK_BINS - 1).cast("long"))).alias("bin"))
    order = Window.partitionBy("volume").orderBy("bin")
    grid = grid.join(counts.select("volume", "bin", "c"), ["volume", "bin"], "left").withColumn("m", F.sum(F.coalesce("c", F.lit(0))).over(order.rowsBetween(-2, 2)))
    grid = grid.withColumns({"a": F.lag("m").over(order), "b": F.lead("m").over(order), "top": F.max("m").over(whole)})
    tops = grid.where((F.col("m") > F.col("a")) & (F.col("m") > F.col("b")) & (F.col("m") * PEAK_SHARE > F.col("top")))
    tops = tops.withColumn("at", F.round(F.col("low") + F.col("width") * (F.col("bin") + 0.5) / PEAK_BINS, 1))
    tops = tops.withColumn("gap", F.col("at") - F.lag("at").over(order))
    apart = F.coalesce(F.min("gap") / F.greatest(F.first("width") * (PEAK_BINS - 1) / PEAK_BINS, F.lit(1e-6)), F.lit(0.0))
    return otsu, tops.groupBy("volume").agg(F.count("*").cast("int").alias("n_peaks"), apart.alias("min_peak_separation"))


def _contrast(at: DataFrame, otsu: DataFrame) -> DataFrame:
    """Distance of the two classes' means in deviations of the lower one."""
    rows = at.join(beside_it(work_table(otsu, "thresholds")), "volume").select("volume", "threshold", F.explode("line").alias("v")).where("v > 0")
    high, low = F.when(F.col("v") > F.col("threshold"), F.col("v")), F.when(F.col("v") <= F.col("threshold"), F.col("v"))
    got = rows.groupBy("volume", "threshold").agg(F.count(high).alias("n1"), F.count(low).alias("n0"), F.avg(high).alias("m1"), F.avg(low).alias("m0"), F.stddev_pop(low).alias("s0"))
    enough = (F.col("n1") >= LEAST_CLASS) & (F.col("n0") >= LEAST_CLASS)
    return got.select("volume", "threshold", F.when(enough, F.abs(F.col("m1") - F.col("m0")) / F.greatest("s0", F.lit(1e-6))).otherwise(0.0).alias("cnr"))


def _noise(at: DataFrame, middle: DataFrame) -> DataFrame:
    """Deviation of positive voxels in the middle slice's corners; where these are few, of the lowest twentieth of all."""
    c = F.greatest(F.floor(F.col("h") / 10), F.lit(5))
    times = ((F.col("y") < c).cast("int") + (F.col("y") >= F.col("h") - c).cast("int")) * ((F.col("x") < c).cast("int") + (F.col("x") >= F.col("w") - c).cast("int"))  # corners may overlap
    corners = middle.where("v > 0").select("volume", F.explode(F.array_repeat("v", times)).alias("v")).groupBy("volume").agg(F.count("*").alias("n"), F.stddev_pop("v").alias("noise_floor"))
    corners = work_table(corners.where(F.col("n") >= LEAST_CORNER).select("volume", "noise_floor"), "corners")
    rest = at.where(F.col("n_pos") >= LEAST_VOXELS).join(beside_it(corners.select("volume")), "volume", "left_anti").select("volume", F.explode("line").alias("v")).where("v > 0")
    cut = work_table(ranks.percentiles(rest, "volume", "v", {"p5": 0.05}).select("volume", "p5"), "cuts")
    dark = rest.join(beside_it(cut), "volume").where("v <= p5").groupBy("volume").agg(F.stddev_pop("v").alias("noise_floor"))
    return corners.unionByName(dark)


def _bias(middle: DataFrame) -> DataFrame:
    """Deviation over mean of the means of the cells of a grid over the middle slice."""
    gh, gw = F.floor(F.col("h") / GRID), F.floor(F.col("w") / GRID)
    cells = middle.where((F.col("d") >= 3) & (gh >= 5) & (gw >= 5) & (F.col("v") > 0)).withColumns({"i": F.floor(F.try_divide(F.col("y"), gh)), "j": F.floor(F.try_divide(F.col("x"), gw))}).where((F.col("i") < GRID) & (F.col("j") < GRID))
    cells = cells.groupBy("volume", "i", "j").agg(F.avg("v").alias("m"), F.count("*").alias("n")).where(F.col("n") > LEAST_CELL)
    return cells.groupBy("volume").agg((F.stddev_pop("m") / F.greatest(F.avg("m"), F.lit(1e-6))).alias("bias_severity"), F.count("*").cast("int").alias("n_patches")).where("n_patches >= 4")


def _edges(at: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gradients of the middle slice, and the variance of the Laplacian (edges wrap round) over sampled slices."""
    d, h, w = F.col("d"), F.col("h"), F.col("w")
    first, last, most = F.floor(d / 6), F.least(d - F.floor(d / 6), d - 1), F.least(F.lit(SAMPLED_SLICES), d)
    picked = F.transform(F.sequence(F.lit(0), most - 1), lambda k: F.floor(first + (last - first) * k / F.greatest(most - 1, F.lit(1))))
    some = at.withColumns({"sampled": F.array_contains(picked, F.col("z").cast("long")), "is_middle": F.col("z") == F.floor(d / 2)}).where("sampled OR is_middle")
    to = lambda y, role: F.struct(y.cast("int").alias("at"), F.lit(role).alias("role"))
    sent = some.select("volume", "z", "h", "w", "sampled", "is_middle", "line", F.explode(F.array(to(F.col("y"), "own"), to((F.col("y") + 1) % h, "above"), to((F.col("y") + h - 1) % h, "below"))).alias("t"))
    role = lambda name: F.max(F.when(F.col("t.role") == name, F.col("line"))).alias(name)
    halo = work_table(sent.groupBy("volume", "z", "h", "w", "sampled", "is_middle", F.col("t.at").alias("y")).agg(role("own"), role("above"), role("below")), "halo")

    left, right = F.concat(F.slice("own", w, F.lit(1)), F.slice("own", F.lit(1), w - 1)), F.concat(F.slice("own", F.lit(2), w - 1), F.slice("own", F.lit(1), F.lit(1)))
    rows = halo.where("sampled").select("volume", "z", F.explode(F.arrays_zip("own", "above", "below", left.alias("left"), right.alias("right"))).alias("p"))
    lap = F.col("p.above") + F.col("p.below") + F.col("p.left") + F.col("p.right") - 4 * F.col("p.own")
    laplacian = rows.groupBy("volume", "z").agg(F.var_pop(lap).alias("v")).groupBy("volume").agg(F.avg("v").alias("laplacian_variance"))

    short = w - 1
    rows = halo.where("is_middle AND y < h - 1").select("volume", F.explode(F.arrays_zip(F.slice("own", F.lit(1), short).alias("a"), F.slice("below", F.lit(1), short).alias("b"), F.slice("own", F.lit(2), short).alias("c"))).alias("p"))
    rows = rows.select("volume", F.sqrt(F.pow(F.col("p.b") - F.col("p.a"), F.lit(2.0)) + F.pow(F.col("p.c") - F.col("p.a"), F.lit(2.0))).alias("g"))
    sharp = ranks.percentiles(rows, "volume", "g", {"sharpness_p95": 0.95}, [F.avg("g").alias("sharpness_mean"), F.stddev_pop("g").alias("sharpness_std")]).drop("n")
    return sharp, laplacian


def band_ratio(image: np.ndarray) -> float:
    """Ratio of the spectral energies of the bands along the two axes, without the mean."""
    m = np.abs(np.fft.fftshift(np.fft.fft2(image)))
    y, x = (n // 2 for n in m.shape)
    m[y, x] = 0
    by, bx = (max(n // 8, 2) for n in m.shape)
    a, b = sorted((float(m[max(y - by, 0) : y + by].sum()), float(m[:, max(x - bx, 0) : x + bx].sum())))
    return b / a if a >= 1e-6 else 1.0


def _ratios(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for i in range(batch.num_rows):
            lines = batch.column(1)[i].values
            found.append(band_ratio(lines.flatten().to_numpy(zero_copy_only=False).reshape(len(lines), -1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["volume", "ghosting_ratio"])


def _spectrum(at: DataFrame) -> DataFrame:
    """The middle slice of each volume is one row here: a spectrum needs all of it."""
    image = at.where(F.col("z") == F.floor(F.col("d") / 2)).groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("y", "line"))).alias("s"))
    kind = at.schema["volume"].dataType.simpleString()
    return image.select("volume", F.transform("s", lambda x: x["line"]).alias("lines")).mapInArrow(_ratios, f"volume {kind}, ghosting_ratio double")


def _word(value: Column, words: tuple, beyond: str, above: bool) -> Column:
    out = F.lit(beyond)
    for cut, word in reversed(words):
        out = F.when(value > cut if above else value < cut, word).otherwise(out)
    return out


def metrics(lines: DataFrame, images: bool = False, small: int = 0, descriptions: DataFrame | None = None) -> DataFrame:
    """volume and FIGURES, one row per volume of lines (volume, z, y, line).

    images: each volume is a single two-dimensional image. small: volumes of at most so many voxels get NEUTRAL values.
    descriptions: volume, description; sagittal and coronal volumes have no halves to compare.
    """
    every = work_table(shapes_of(lines), "shapes")
    shapes = every.where("whole").drop("whole")
    at = lines.select("volume", "z", "y", F.transform("line", lambda x: x.cast("double")).alias("line")).join(beside_it(shapes), "volume")
    middle = at.where(F.col("z") == F.floor(F.col("d") / 2)).select("volume", "d", "h", "w", "y", F.posexplode("line").alias("x", "v"))
    otsu, tops = _histograms(at, shapes)
    sharp, laplacian = _edges(at)
    parts = [_symmetry(at), _pairs(at), _contrast(at, otsu), tops, _noise(at, middle), _bias(middle), sharp, laplacian, _spectrum(at)]
    out = reduce(lambda a, b: a.join(b, "volume", "left"), parts, shapes)
    told = F.lit("")
    if descriptions is not None:
        out, told = out.join(descriptions.select("volume", F.upper("description").alias("_told")).dropDuplicates(["volume"]), "volume", "left"), F.coalesce("_told", F.lit(""))
    thin, flat = F.col("d") < 3, F.lit(images)
    turned = reduce(lambda a, b: a | b, [F.contains(told, F.lit(x)) for x in NOT_AXIAL])
    none = F.when(flat, "N/A (2D)").when(turned, "N/A (non-axial)").when(thin, "N/A (single slice)")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    near = F.coalesce("_near", F.lit(1.0))
    ratio = F.col("ghosting_ratio")
    floor = F.when(flat, 0.0).otherwise(zero("noise_floor"))
    peaks, apart = F.coalesce("n_peaks", F.lit(0)), zero("min_peak_separation")
    made = {
        "symmetry_index": F.when(none.isNotNull(), 1.0).otherwise(F.greatest(zero("_r"), F.lit(0.0))),
        "symmetry": F.coalesce(none, _word(zero("_r"), SYMMETRY, "significant asymmetry", above=True)),
        "asymmetry_mean": F.when(none.isNotNull(), 0.0).otherwise(zero("_asym")),
        "sharpness_mean": zero("sharpness_mean"),
        "sharpness_std": zero("sharpness_std"),
        "sharpness_p95": zero("sharpness_p95"),
        "ghosting_ratio": ratio,
        "slice_correlation": near,
        "motion": (ratio > 2.5) & (near < 0.8),
        "motion_score": F.least(60 * F.least((ratio - 1) / 4, F.lit(1.0)) + 40 * F.greatest(F.lit(0.0), (1 - near) / 0.3), F.lit(100.0)),
        "cnr": zero("cnr"),
        "threshold": F.col("threshold"),
        "noise_floor": floor,
        "rician_sigma": floor / RICIAN,
        "noise": _word(floor, NOISE, "high noise", above=False),
        "bias_severity": zero("bias_severity"),
        "n_patches": F.coalesce("n_patches", F.lit(0)),
        "laplacian_variance": zero("laplacian_variance"),
        "n_peaks": peaks,
        "min_peak_separation": apart,
        "segmentation": F.when((peaks >= 3) & (apart > 0.1), "easy").when(peaks >= 2, "medium").otherwise("hard"),
        "mean_correlation": F.coalesce("mean_correlation", F.lit(1.0)),
        "min_correlation": F.coalesce("min_correlation", F.lit(1.0)),
        "std_correlation": zero("std_correlation"),
        "n_pairs": F.coalesce("n_pairs", F.lit(0)),
    }
    tiny = F.col("n") <= small
    made |= {k: F.when(tiny, v).otherwise(made[k]) for k, v in NEUTRAL.items()}
    return every.select("volume").join(out.select("volume", *[made[f].alias(f) for f in FIGURES]), "volume", "left")
