"""Tar archives by their index: what is in them, without reading contents, and packs of files written where they are missing.

Packs are planned from sizes alone, by prefix sums inside a key, so a key of very many files is many packs and many
tasks; contents go from file to archive in pieces, and an archive appears under its name only when it is whole.
"""

from __future__ import annotations

import tarfile
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.sources.dicom import Files
from radspan.sources.scratch import spread, work_table

#: Bytes of a pack, contents with their header blocks; of a piece that is copied at once.
MOST, PIECE = 256 << 20, 1 << 20
BLOCK = 512


def index_of(file: BinaryIO) -> Iterator[tuple[str, int, int]]:
    """name, offset of the content, size of each member of an uncompressed tar; only header blocks are read."""
    with tarfile.open(fileobj=file, mode="r:") as tar:
        for member in tar:
            yield member.name, member.offset_data, member.size
            tar.members = []  # nothing of a long archive is kept


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = Files()
    names = ["archive", "member", "offset", "size", "error"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        rows: list[tuple] = []
        for path in batch.column(0).to_pylist():
            try:
                store, place = files.at(path)
                with store.open_input_file(place) as file:
                    for member in index_of(file):
                        rows.append((path, *member, None))
                        if len(rows) >= 4096:
                            yield batch_of(rows)
                            rows = []
            except (tarfile.TarError, OSError) as odd:
                rows.append((path, None, None, None, str(odd) or type(odd).__name__))
        if rows:
            yield batch_of(rows)


def members(archives: DataFrame) -> DataFrame:
    """archive, member, offset, size, error of tars at the paths of `archives` (path); one that cannot be read, or ends too
    early, has a row with an error after the members that it does have; an empty one has no row."""
    return spread(archives.select("path").where("path IS NOT NULL"), "path").mapInArrow(_members, "archive string, member string, offset long, size long, error string")


def taken(size: Column) -> Column:
    """Bytes of a file in an archive: its header block, and its content in whole blocks."""
    return (F.ceil(size / BLOCK) * BLOCK + BLOCK).cast("long")


def packs(files: DataFrame, by: str, name: str, size: str, most: int = MOST) -> DataFrame:
    """files with `part`, from 0 and gapless for each `by`: the files of a part take at most `most` bytes, or it is one file.

    In order of name, a file lies between two sums of sizes. Those that lie between two multiples of `most` are one part,
    and one that lies across a multiple is a part of its own, so no part waits for another. Rows with a null size or name
    have a null part; equal names are told apart by nothing, so their order is open.
    """
    if most < 1:
        raise ValueError(f"a pack holds at least one byte, not {most}")
    whole = F.col(name).isNotNull() & F.col(size).isNotNull()
    rows = work_table(files.where(whole).repartitionByRange(by, name).withColumn("_pack_tile", F.spark_partition_id()), "tiles")
    # a tile is one task's share of the order; the sums before it come from a row for each key and tile
    tiles = rows.groupBy(by, "_pack_tile").agg(F.sum(taken(F.col(size))).alias("_pack_sum"))
    before = Window.partitionBy(by).orderBy("_pack_tile").rowsBetween(Window.unboundedPreceding, -1)
    starts = tiles.select(F.col(by).alias("_pack_by"), F.col("_pack_tile").alias("_pack_at"), F.coalesce(F.sum("_pack_sum").over(before), F.lit(0)).alias("_pack_before"))
    inside = Window.partitionBy(by, "_pack_tile").orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(starts.hint("merge"), F.col(by).eqNullSafe(F.col("_pack_by")) & (F.col("_pack_tile") == F.col("_pack_at"))).withColumn("_pack_end", F.col("_pack_before") + F.sum(taken(F.col(size))).over(inside))
    first, last = F.floor((F.col("_pack_end") - taken(F.col(size))) / most), F.floor((F.col("_pack_end") - 1) / most)
    placed = placed.withColumn("_pack_cell", F.when(first == last, first * 2).otherwise(first * 2 + 1)).select(*files.columns, "_pack_cell")
    numbers = placed.select(F.col(by).alias("_pack_by"), F.col("_pack_cell").alias("_pack_of")).distinct()
    numbers = numbers.withColumn("part", F.row_number().over(Window.partitionBy("_pack_by").orderBy("_pack_of")) - 1)
    numbered = placed.join(numbers.hint("merge"), F.col(by).eqNullSafe(F.col("_pack_by")) & (F.col("_pack_cell") == F.col("_pack_of"))).select(*files.columns, "part")
    return numbered.unionByName(files.where(~whole).withColumn("part", F.lit(None).cast("int")))


def _written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files, at, tar, out, n, fresh = Files(), None, None, None, 0, ""

    def closed() -> pa.RecordBatch:
        tar.close()
        size = out.tell()
        out.close()
        store, place = files.at(at)
        store.move(fresh, place)
        return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["archive", "n", "bytes"])

    for batch in batches:
        for archive, member, path in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if archive != at:
                if tar is not None:
                    yield closed()
                at, n = archive, 0
                store, place = files.at(archive)
                store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                fresh = f"{place}.new-{uuid.uuid4().hex}"
                out = store.open_output_stream(fresh)
                tar = tarfile.open(fileobj=out, mode="w|", bufsize=PIECE)
            source, place = files.at(path)
            with source.open_input_file(place) as file:
                info = tarfile.TarInfo(member)
                info.size = file.size()
                tar.addfile(info, file)
            n += 1
    if tar is not None:
        yield closed()


def write(files: DataFrame, root: str, by: str, name: str, path: str, size: str, most: int = MOST) -> DataFrame:
    """archive, n, bytes, skipped: one row for each pack, `root`/<by>/<part>.tar; files: one row for each member.

    A pack that is there whole, with as many members as are planned, is left as it is (skipped, bytes null); another one
    is written anew. The packs are written once, before this returns. An attempt that dies leaves a file `*.new-<id>`, no
    half archive; archives of parts that are no longer planned stay. ValueError if a name, key or size is null.
    """
    spark = files.sparkSession
    plan = work_table(packs(files.select(F.col(by).cast("string").alias("_by"), F.col(name).alias("_name"), F.col(path).alias("_path"), F.col(size).alias("_size")), "_by", "_name", "_size", most), "packs")
    if not plan.where("part IS NULL OR _by IS NULL OR _path IS NULL").isEmpty():
        raise ValueError("a file without a key, name, path or size has no place in an archive")
    archive = F.concat(F.lit(root.rstrip("/") + "/"), F.col("_by"), F.lit("/"), F.col("part").cast("string"), F.lit(".tar"))
    plan = plan.select(archive.alias("archive"), "_name", "_path")
    counts = plan.groupBy("archive").agg(F.count("*").alias("n"))
    old = members(_there(spark, root)).groupBy("archive").agg(F.count("member").alias("_n"), F.count("error").alias("_bad")) if _exists(spark, root) else None
    done = counts.limit(0) if old is None else counts.join(old.hint("merge"), "archive").where("n = _n AND _bad = 0").select("archive", "n")
    done = work_table(done, "done")
    todo = spread(plan.join(done.select("archive").hint("merge"), "archive", "left_anti"), "archive").sortWithinPartitions("archive", "_name")
    fresh = work_table(todo.mapInArrow(_written, "archive string, n long, bytes long"), "written").withColumn("skipped", F.lit(False))
    return fresh.unionByName(done.select("archive", "n", F.lit(None).cast("long").alias("bytes"), F.lit(True).alias("skipped")))


def _exists(spark: SparkSession, root: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _there(spark: SparkSession, root: str) -> DataFrame:
    """Archives below a folder, in the form of path that write() uses."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tar").load(root).select("path")
    return rows.select(F.concat(F.lit(root.rstrip("/")), F.regexp_extract("path", r"(/[^/]*/[^/]*\.tar)$", 1)).alias("path"))
