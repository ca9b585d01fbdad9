"""Volumes as a chunked pyramid: a table of blocks (volume, level, key), its levels, and reads of a box.

A store is a folder: `blocks/` in parts by level, each file a range of (volume, key); `levels/` with a row for each volume
and level; `refused/` with the volumes that could not be stored; `files/` with the range that each file of blocks holds.
The key of a block interleaves the bits of its places (Morton order), so a box is a few ranges of keys, and a read opens
only the files whose range meets one of them. Volumes come and go as image lines (volume, z, y, line), so neither a
volume nor a level has to fit a row or a task; a row of `blocks` holds one chunk.

Each level holds the means of 2 x 2 x 2 voxels of the one above, odd sides padded with zeros: all levels come from the
sums over 2^k x 2^k x 2^k of the lines, in one shuffle. Defined cases: a volume with a missing or repeated line, lines of
different lengths, or a null, NaN or infinite voxel is refused, and so is one of no voxels; the others are stored. A box
that lies outside, a level or a volume that is not there gives no rows; a box is cut at the sides of the volume.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.operators.slices import shapes_of
from radspan.sources.scratch import work_table

CHUNK = (16, 256, 256)
#: Bits of a place that go into a key: up to 2^21 blocks along a side.
BITS = 21
#: A box is covered by about so many ranges of keys; finer parts of it are taken with their surroundings and cut later.
RANGES = 64


def morton(z: Column, y: Column, x: Column) -> Column:
    bit = lambda c, i, at: F.shiftleft(F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1).cast("long")), 3 * i + at)
    parts = [bit(c, i, at) for i in range(BITS) for c, at in ((z, 2), (y, 1), (x, 0))]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def key_ranges(low: tuple[int, int, int], high: tuple[int, int, int], most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of keys (both ends in) that cover all blocks from low to high, both in: cubes of the octree, larger ones first."""
    bits = max(*(h.bit_length() for h in high), 1)
    inside, partly = [], [(0, (0, 0, 0), bits)]  # first key, corner, bits of the side

    def within(corner: tuple[int, int, int], b: int, whole: bool) -> bool:
        ends = [c + (1 << b) - 1 for c in corner]
        return all((lo <= c and e <= hi) if whole else (e >= lo and c <= hi) for c, e, lo, hi in zip(corner, ends, low, high, strict=True))

    while partly and len(inside) + len(partly) < most:
        whole = [cube for cube in partly if within(cube[1], cube[2], True)]
        inside += whole
        finer = []
        for key, (z, y, x), b in partly:
            if (key, (z, y, x), b) not in whole:
                half = 1 << (b - 1)
                finer += [(key + (i << 3 * (b - 1)), (z + half * (i >> 2), y + half * (i >> 1 & 1), x + half * (i & 1)), b - 1) for i in range(8)]
        partly = [cube for cube in finer if within(cube[1], cube[2], False)]
    merged: list[tuple[int, int]] = []
    for a, z in sorted((k, k + (1 << 3 * b) - 1) for k, _, b in inside + partly):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(z, merged[-1][1]))
        else:
            merged.append((a, z))
    return merged


def level_lines(lines: DataFrame, levels: int) -> DataFrame:
    """volume, level, z, y, line (floats) of all levels of whole volumes, level 0 as it is.

    A line gives its sums over 2^k voxels to line (z / 2^k, y / 2^k) of level k, where at most 4^k of them are added up.
    """
    if levels < 1:
        raise ValueError(f"a pyramid has at least one level, not {levels}")
    v = F.transform("line", lambda x: x.cast("double"))
    same = lines.select("volume", F.lit(0).alias("level"), "z", "y", v.cast("array<float>").alias("line"))
    if levels == 1:
        return same

    def halves(k: int) -> Column:
        step = 1 << k
        places = F.sequence(F.lit(0), F.ceil(F.size("_v") / step).cast("int") - 1)
        sums = F.transform(places, lambda i: F.aggregate(F.slice("_v", i * step + 1, F.lit(step)), F.lit(0.0), lambda a, x: a + x))
        return F.struct(F.lit(k).alias("level"), sums.alias("sums"))

    rows = lines.select("volume", "z", "y", v.alias("_v")).select("volume", "z", "y", F.inline(F.array(*[halves(k) for k in range(1, levels)])))
    cell = [F.expr(f"shiftright({c}, level)").alias(f"_{c}") for c in ("z", "y")]
    groups = rows.select("volume", "level", *cell, F.struct("z", "y", "sums").alias("_part")).groupBy("volume", "level", "_z", "_y").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    zero = F.transform(F.get("_parts", F.lit(0))["sums"], lambda _: F.lit(0.0))
    total = F.aggregate("_parts", zero, lambda a, p: F.zip_with(a, p["sums"], lambda s, t: s + t))
    count = F.pow(F.lit(8.0), F.col("level"))
    means = groups.withColumn("_n", count).select("volume", "level", F.col("_z").alias("z"), F.col("_y").alias("y"), F.transform(total, lambda s: (s / F.col("_n")).cast("float")).alias("line"))
    return same.unionByName(means)


def blocks(lines: DataFrame, chunk: tuple[int, int, int] = CHUNK) -> DataFrame:
    """volume, level, key, cz, cy, cx, nz, ny, nx, values (z, y, x in row order) of lines of all levels; a group is one chunk."""
    dz, dy, dx = chunk
    pieces = F.transform(F.sequence(F.lit(0), F.ceil(F.size("line") / dx).cast("int") - 1), lambda i: F.struct(i.alias("cx"), F.slice("line", i * dx + 1, F.lit(dx)).alias("piece")))
    rows = lines.select("volume", "level", F.expr(f"z div {dz}").cast("int").alias("cz"), F.expr(f"y div {dy}").cast("int").alias("cy"), "z", "y", F.inline(pieces))
    found = rows.groupBy("volume", "level", "cz", "cy", "cx").agg(F.sort_array(F.collect_list(F.struct("z", "y", "piece"))).alias("_rows"))
    first, last = F.get("_rows", F.lit(0)), F.element_at("_rows", -1)
    sides = [(last[c] - first[c] + 1).alias(f"n{c}") for c in ("z", "y")]
    values = F.flatten(F.transform("_rows", lambda r: r["piece"]))
    return found.select("volume", "level", morton(F.col("cz"), F.col("cy"), F.col("cx")).alias("key"), "cz", "cy", "cx", *sides, F.size(first["piece"]).alias("nx"), values.alias("values"))


def write(lines: DataFrame, path: str, levels: int = 4, chunk: tuple[int, int, int] = CHUNK, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> None:
    """Stores volumes of lines (see the module); the lines are read three times, so hand in a table, not a long computation.

    `levels/` tells (volume, level, name, d, h, w, scale, chunk, n_blocks, n_bytes): scale is the spacing times 2^level, a
    chunk is no larger than its level. A store at `path` is replaced; `files/` is written last, and without it there is
    no store.
    """
    spark = lines.sparkSession
    if levels < 1:
        raise ValueError(f"a pyramid has at least one level, not {levels}")
    spark.createDataFrame([], "file string").write.mode("overwrite").json(f"{path}/files")  # an older store ends here
    ok = F.coalesce("whole", F.lit(False)) & (F.col("n") > 0)
    known = lines.select("volume").distinct().join(shapes_of(lines), "volume", "left").withColumn("_ok", F.coalesce(ok, F.lit(False)))
    known = work_table(known.select("volume", "d", "h", "w", "_ok"), "shapes")
    known.where("NOT _ok").select("volume", F.lit("lines are missing, repeated, of different lengths or not of numbers").alias("error")).write.mode("overwrite").parquet(f"{path}/refused")
    good = lines.join(known.where("_ok").select("volume"), "volume", "left_semi")
    rows = blocks(level_lines(good, levels), chunk)
    rows.repartitionByRange("level", "volume", "key").sortWithinPartitions("level", "volume", "key").write.mode("overwrite").partitionBy("level").parquet(f"{path}/blocks")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/blocks")
    scale, side = F.array(*map(F.lit, spacing)), F.array("d", "h", "w")
    factor = F.pow(F.lit(2.0), F.col("level"))
    per = stored.groupBy("volume", "level").agg(F.count("*").alias("n_blocks"), F.sum(F.col("nz").cast("long") * F.col("ny") * F.col("nx") * 4).alias("n_bytes"))
    told = per.join(known.where("_ok"), "volume").withColumn("_side", F.transform(side, lambda n: F.ceil(n / factor).cast("int")))
    sides = [F.get("_side", F.lit(i)).alias(c) for i, c in enumerate("dhw")]
    told.select("volume", "level", F.concat(F.lit("s"), "level").alias("name"), *sides, F.transform(scale, lambda s: s * factor).alias("scale"), F.zip_with("_side", F.array(*map(F.lit, chunk)), lambda n, c: F.least(n, c)).alias("chunk"), "n_blocks", "n_bytes").write.mode("overwrite").parquet(f"{path}/levels")
    ends = stored.groupBy(F.col("_metadata.file_path").alias("file"), "level").agg(F.min(F.struct("volume", "key")).alias("low"), F.max(F.struct("volume", "key")).alias("high"))
    ends.write.mode("overwrite").parquet(f"{path}/files")


def box_files(spark: SparkSession, path: str, volume: object, level: int, ranges: list[tuple[int, int]]) -> list[str]:
    """Files of blocks that may hold one of the ranges of keys of a volume's level; the list is that of one read's files."""
    at = lambda k: F.struct(F.lit(volume).alias("volume"), F.lit(k).cast("long").alias("key"))
    index = spark.read.parquet(f"{path}/files").where(F.col("level") == level)
    kind = index.schema["low"].dataType
    meets = reduce(lambda a, b: a | b, [(F.col("low") <= at(z).cast(kind)) & (F.col("high") >= at(a).cast(kind)) for a, z in ranges], F.lit(False))
    return sorted(r.file for r in index.where(meets).select("file").collect())


def box(spark: SparkSession, path: str, volume: object, level: int = 0, low: tuple[int, int, int] = (0, 0, 0), high: tuple[int, int, int] | None = None) -> DataFrame:
    """z, y, x, line: the voxels of a level from low up to but without high (z, y, x), each line in pieces by chunk.

    x is the place of the first voxel of a piece. high None: to the end of the volume. ValueError for a box without voxels.
    """
    told = spark.read.parquet(f"{path}/levels").where((F.col("volume") == F.lit(volume)) & (F.col("level") == level)).first()
    # the step of the chunks is that of level 0, as a level may be smaller than a chunk
    step = spark.read.parquet(f"{path}/levels").where((F.col("volume") == F.lit(volume)) & (F.col("level") == 0)).select("chunk").first()
    empty = spark.createDataFrame([], "z int, y int, x int, line array<float>")
    if told is None or step is None:
        return empty
    sides = (told.d, told.h, told.w)
    low = tuple(max(0, lo) for lo in low)
    high = sides if high is None else tuple(min(h, n) for h, n in zip(high, sides, strict=True))
    if any(h <= lo for lo, h in zip(low, high, strict=True)):
        return empty
    first, last = [tuple(c // s for c, s in zip(at, step.chunk, strict=True)) for at in (low, [h - 1 for h in high])]
    ranges = key_ranges(first, last)
    files = box_files(spark, path, volume, level, ranges)
    if not files:
        return empty
    near = reduce(lambda a, b: a | b, [F.col("key").between(a, z) for a, z in ranges])
    names = ("cz", "cy", "cx")
    exact = reduce(lambda a, b: a & b, [F.col(c).between(lo, hi) for c, lo, hi in zip(names, first, last, strict=True)])
    rows = spark.read.option("basePath", f"{path}/blocks").parquet(*files).where((F.col("level") == level) & (F.col("volume") == F.lit(volume)) & near & exact)
    z0, y0, x0 = [F.col(c) * s for c, s in zip(names, step.chunk, strict=True)]
    a, b = F.greatest(x0, F.lit(low[2])), F.least(x0 + F.col("nx"), F.lit(high[2]))
    rows = rows.select("nx", "ny", "values", z0.alias("_z"), y0.alias("_y"), a.alias("x"), (a - x0).alias("_from"), (b - a).alias("_n"), F.explode(F.sequence(F.lit(0), F.col("nz") * F.col("ny") - 1)).alias("_i"))
    rows = rows.withColumn("z", F.expr("_z + _i div ny").cast("int")).withColumn("y", (F.col("_y") + F.col("_i") % F.col("ny")).cast("int"))
    rows = rows.where(F.col("z").between(low[0], high[0] - 1) & F.col("y").between(low[1], high[1] - 1))
    return rows.select("z", "y", "x", F.slice("values", F.col("_i") * F.col("nx") + F.col("_from") + 1, F.col("_n")).alias("line"))
