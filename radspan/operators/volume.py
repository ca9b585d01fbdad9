"""Array maths on volumes: row expressions without a shuffle for histograms and masks, small windows over bins and slices.
What needs transforms or neighbourhoods (symmetry, sharpness, motion, noise, bias, edges) is in `slices`."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from radspan.operators import slices


def _doubles(values: Column) -> Column:
    return F.transform(values, lambda x: x.cast("double"))


def mean(values: Column) -> Column:
    return F.aggregate(_doubles(values), F.lit(0.0), lambda a, x: a + x) / F.size(values)


def moment(values: Column, order: int) -> Column:
    """The central population moment."""
    m = mean(values)
    return F.aggregate(F.transform(_doubles(values), lambda x: F.pow(x - m, F.lit(order))), F.lit(0.0), lambda a, x: a + x) / F.size(values)


def skew_kurtosis(values: Column) -> tuple[Column, Column]:
    """Population skewness and excess kurtosis; 0 for a constant array."""
    var = moment(values, 2)
    flat = F.sqrt(var) < 1e-10
    return F.when(flat, 0.0).otherwise(moment(values, 3) / F.pow(var, F.lit(1.5))), F.when(flat, 0.0).otherwise(moment(values, 4) / (var * var) - 3)


def percentile(values: Column, q: float) -> Column:
    """Linear interpolation between neighbours in order; q from 0 to 1."""
    s = F.array_sort(_doubles(values))
    at = F.lit(q) * (F.size(values) - 1)
    low = F.floor(at).cast("int")
    a, b = F.get(s, low), F.coalesce(F.get(s, low + 1), F.get(s, low))
    return a + (b - a) * (at - low)


def bound(value: Column, then) -> Column:
    """then(value), with the value computed once however often `then` uses it, inside lambdas too."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def binned(v: np.ndarray, bins: int) -> tuple[np.ndarray, float, float]:
    """Counts in equal-width bins, the least value and the width of all; a constant array is one unit wide around its value."""
    low, high = float(v.min()), float(v.max())
    low, width = (low - 0.5, 1.0) if low == high else (low, high - low)
    places = np.minimum(np.floor((v - low) / width * bins).astype(np.int64), bins - 1)
    return np.bincount(places, minlength=bins), low, width


def with_histogram(df: DataFrame, values: str, bins: int, name: str = "counts") -> DataFrame:
    """df with counts in equal-width bins from the least to the greatest value, the last one closed, and _low and _width.

    A constant array is one unit wide around its value. Nulls, NaN and infinities inside an array are not counted; an
    array without any value has counts of 0 and no width; a null array gives nulls. Each array is passed over once.
    """
    at = df.columns.index(values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch.column(at).to_pylist():
                v = None if v is None else np.array([x for x in v if x is not None], np.float64)
                v = None if v is None else v[np.isfinite(v)]
                if v is None or not len(v):
                    found.append((None if v is None else [0] * bins, None, None))
                    continue
                n, low, width = binned(v, bins)
                found.append((n.tolist(), low, width))
            counts, lows, widths = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.list_(pa.int32())), pa.array(lows, pa.float64()), pa.array(widths, pa.float64())], names=[*batch.schema.names, name, "_low", "_width"])

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType())), T.StructField("_low", T.DoubleType()), T.StructField("_width", T.DoubleType())])
    return df.mapInArrow(run, schema)


def entropy(df: DataFrame, values: str, bins: int = 256, name: str = "entropy") -> DataFrame:
    """df with the Shannon entropy in bits of the histogram."""
    out = with_histogram(df, values, bins, "_counts")
    share = F.transform(F.filter("_counts", lambda n: n > 0), lambda n: n / F.size(values))
    value = -F.aggregate(F.transform(share, lambda x: x * F.log2(x)), F.lit(0.0), lambda a, x: a + x)
    return out.withColumn(name, value).drop("_counts", "_low", "_width")


def normalised(df: DataFrame, values: str, low: float = 0.01, high: float = 0.99, name: str = "normalised") -> DataFrame:
    """df with the values between two percentiles scaled to 0..1, outside clipped."""
    out = df.withColumn("_a", percentile(F.col(values), low)).withColumn("_b", percentile(F.col(values), high))
    scaled = F.transform(_doubles(F.col(values)), lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - F.col("_a")) / F.greatest(F.col("_b") - F.col("_a"), F.lit(1e-6)))))
    return out.withColumn(name, scaled).drop("_a", "_b")


def windowed(values: Column, centre: float, width: float) -> Column:
    """A radiological window, scaled to 0..1."""
    low = centre - width / 2
    return F.transform(_doubles(values), lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (width + 1e-6))))


def min_max_mask(values: Column, threshold: float = 0.3) -> Column:
    """Whether the value, scaled from the least to the greatest, is above the threshold."""
    v = _doubles(values)
    lo, hi = F.array_min(v), F.array_max(v)
    return F.transform(v, lambda x: (x - lo) / F.greatest(hi - lo, F.lit(1e-8)) > threshold)


def tissue_mask(values: Column, low: float = 0.15, high: float = 0.99) -> Column:
    """Whether the value lies strictly between two percentiles of its array."""
    cuts = F.struct(percentile(values, low).alias("a"), percentile(values, high).alias("b"))
    return bound(cuts, lambda p: F.transform(_doubles(values), lambda x: (x > p["a"]) & (x < p["b"])))


def projection(values: Column, outer: int, inner: int, largest: bool = True) -> Column:
    """Maximum (or minimum) over the first axis of an outer x inner array."""
    pick = F.array_max if largest else F.array_min
    return F.transform(F.sequence(F.lit(0), F.lit(inner - 1)), lambda i: pick(F.transform(F.sequence(F.lit(0), F.lit(outer - 1)), lambda o: F.get(values, o * inner + i))))


def bins_long(df: DataFrame, key: str, values: str, bins: int) -> DataFrame:
    """key, bin (from 0), n, centre."""
    rows = with_histogram(df.select(key, values), values, bins, "_counts").select(key, "_low", "_width", F.posexplode("_counts").alias("bin", "n"))
    return rows.select(key, "bin", "n", (F.col("_low") + F.col("_width") * (F.col("bin") + 0.5) / bins).alias("centre"))


def otsu(df: DataFrame, key: str, values: str, bins: int = 256) -> DataFrame:
    """key, threshold: the first bin centre with the largest variance between the classes on its two sides."""
    rows = bins_long(df, key, values, bins)
    run = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(key)
    rows = rows.withColumns({"w0": F.sum("n").over(run), "s0": F.sum(F.col("n") * F.col("centre")).over(run), "w": F.sum("n").over(whole), "s": F.sum(F.col("n") * F.col("centre")).over(whole)})
    w1 = F.col("w") - F.col("w0")
    between = F.when((F.col("w0") > 0) & (w1 > 0), F.col("w0") * w1 * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1, F.lit(2.0))).otherwise(0.0)
    return rows.select(key, "centre", F.round(between, 9).alias("b"), "bin").groupBy(key).agg(F.max_by("centre", F.struct("b", -F.col("bin"))).alias("threshold"))


def peaks(df: DataFrame, key: str, values: str, bins: int = 128) -> DataFrame:
    """key, n_peaks: local maxima of the histogram's five-bin moving mean above a twentieth of its largest."""
    order = Window.partitionBy(key).orderBy("bin")
    rows = bins_long(df, key, values, bins).withColumn("m", F.sum("n").over(order.rowsBetween(-2, 2)))
    rows = rows.withColumns({"a": F.lag("m").over(order), "b": F.lead("m").over(order), "top": F.max("m").over(Window.partitionBy(key))})
    return rows.groupBy(key).agg(F.count_if((F.col("m") > F.col("a")) & (F.col("m") > F.col("b")) & (F.col("m") * 20 > F.col("top"))).alias("n_peaks"))


def anomalous_slices(df: DataFrame, key: str, value: str, limit: float = 3.0, least: int = 3) -> DataFrame:
    """Rows with z and flag (bright, dark or null) against their volume's mean and population deviation.

    The figures come from a partial aggregate that is joined back, so no window holds a large volume.
    """
    stats = df.groupBy(key).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"), F.count("*").alias("_n")).where((F.col("_n") >= least) & (F.col("_s") >= 1e-6))
    out = df.join(stats, key).withColumn("z", (F.col(value) - F.col("_m")) / F.col("_s"))
    return out.withColumn("flag", F.when(F.col("z") > limit, "bright").when(F.col("z") < -limit, "dark")).drop("_m", "_s", "_n")


def adjacent_correlation(df: DataFrame, key: str, values: str, slices: int, size: int) -> DataFrame:
    """key, mean and least correlation of neighbouring slices of an array of slices x size."""
    pairs = df.select(key, F.explode(F.transform(F.sequence(F.lit(0), F.lit(slices - 2)), lambda i: F.struct(F.slice(values, i * size + 1, size).alias("a"), F.slice(values, (i + 1) * size + 1, size).alias("b")))).alias("p"))
    a, b = _doubles(F.col("p.a")), _doubles(F.col("p.b"))
    ma, mb = mean(F.col("p.a")), mean(F.col("p.b"))
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: (x - ma) * (y - mb)), F.lit(0.0), lambda s, x: s + x) / size
    r = dot / F.sqrt(moment(F.col("p.a"), 2) * moment(F.col("p.b"), 2))
    return pairs.select(key, r.alias("r")).groupBy(key).agg(F.avg("r").alias("mean_correlation"), F.min("r").alias("min_correlation"))


def halved(df: DataFrame, key: str, values: str, side: int) -> DataFrame:
    """key, values: the next level of a pyramid of a cube of side x side x side, means over 2 x 2 x 2 (odd sides zero-padded)."""
    out = (side + 1) // 2
    places = F.sequence(F.lit(0), F.lit(out**3 - 1))
    at = lambda z, y, x: F.when((z < side) & (y < side) & (x < side), F.get(F.col(values), ((z * side + y) * side + x).cast("int"))).otherwise(0.0)

    def cell(i: Column) -> Column:
        z, y, x = F.floor(i / (out * out)) * 2, F.floor(i / out) % out * 2, i % out * 2
        total = F.lit(0.0)
        for dz in (0, 1):
            for dy in (0, 1):
                for dx in (0, 1):
                    total = total + F.coalesce(at(z + dz, y + dy, x + dx).cast("double"), F.lit(0.0))
        return total / 8

    return df.select(key, F.transform(places, cell).alias(values))


def label_volumes(df: DataFrame, key: str, mask: str, voxel_mm3: Column) -> DataFrame:
    """key, label, cc: counts of non-zero labels times the voxel volume."""
    rows = df.select(key, voxel_mm3.alias("_v"), F.explode(mask).alias("label")).where("label <> 0")
    return rows.groupBy(key, "label").agg((F.count("*") * F.first("_v") / 1000).alias("cc"))


def voxel_volume(affine: Column) -> Column:
    """The absolute determinant of the upper left 3 x 3 of an array of rows."""
    m = lambda i, j: F.get(F.get(affine, F.lit(i)), F.lit(j))
    return F.abs(m(0, 0) * (m(1, 1) * m(2, 2) - m(1, 2) * m(2, 1)) - m(0, 1) * (m(1, 0) * m(2, 2) - m(1, 2) * m(2, 0)) + m(0, 2) * (m(1, 0) * m(2, 1) - m(1, 1) * m(2, 0)))


def field_of_view(shape: Column, spacing: Column) -> Column:
    return F.zip_with(shape, F.reverse(spacing), lambda n, s: n * s)


def split_threshold(x: np.ndarray, bins: int = 256) -> float:
    """The threshold of largest variance between two classes."""
    n, edges = np.histogram(x, bins)
    c = (edges[1:] + edges[:-1]) / 2
    w, s = np.cumsum(n), np.cumsum(n * c)
    with np.errstate(all="ignore"):
        b = np.nan_to_num(w * (w[-1] - w) * (s / w - (s[-1] - s) / (w[-1] - w)) ** 2)
    return float(c[b.argmax()])


def with_metrics(df: DataFrame, key: str, values: str, shape: tuple[int, ...], description: str | None = None, small: int = 0) -> DataFrame:
    """key and all figures of `slices` for volumes that are one array a row; arrays that do not have the shape give nulls.
    description: a column that tells sagittal and coronal series; small: volumes of at most so many voxels are neutral."""
    told = None if description is None else df.select(F.col(key).alias("volume"), F.col(description).alias("description"))
    found = slices.metrics(slices.lines_of(df, key, values, shape), len(shape) < 3, small, told)
    return df.select(key).join(found.withColumnRenamed("volume", key), key, "left")
