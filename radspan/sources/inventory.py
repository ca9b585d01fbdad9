"""File inventories and per-type metadata over Spark's binary and text readers."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.sources.dicom import Files
from radspan.sources.scratch import spread, work_table

# fixed values: extensions of each kind of file
KINDS = {"dicom": "dcm|dicom|ima|img", "json": "json", "csv": "csv|tsv", "nifti": "nii", "image": "png|jpg|jpeg|gif|bmp", "text": "txt|md|log|yaml|yml", "parquet": "parquet"}


#: files of a batch of a list
LISTED_BATCH = 10_000


def files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """path, length, modificationTime, content of all files below root, by a glob on the name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader if pattern is None else reader.option("pathGlobFilter", pattern)).load(root)


def _list(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stores = Files()
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            store, place = stores.at(folder)
            found = store.get_file_info(fs.FileSelector(place))
            for at in range(0, len(found), LISTED_BATCH):
                some = found[at : at + LISTED_BATCH]
                path = pa.array([f"{folder.rstrip('/')}/{f.base_name}" for f in some], pa.string())
                time = pa.array([None if f.mtime_ns is None else f.mtime_ns // 1000 for f in some], pa.int64()).cast(pa.timestamp("us", "UTC"))
                kind = pa.array([f.type == fs.FileType.Directory for f in some], pa.bool_())
                yield pa.RecordBatch.from_arrays([path, pa.array([f.size for f in some], pa.int64()), time, kind], names=["path", "length", "modificationTime", "folder"])


def listed(spark: SparkSession, root: str) -> DataFrame:
    """path, length, modificationTime of all files below root, listed in tasks: a round for each level, a folder at a time.

    The driver sees neither files nor folders. Names that start with a dot or an underscore are left out, as Spark does.
    """
    found, folders_ = None, spark.createDataFrame([(root,)], "path string")
    while True:
        level = work_table(folders_.mapInArrow(_list, "path string, length long, modificationTime timestamp, folder boolean").where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]")), "level")
        rows = level.where("NOT folder").drop("folder")
        found = rows if found is None else found.unionByName(rows)
        below = level.where("folder").select("path")
        if below.isEmpty():
            return found
        folders_ = spread(below, "path")


def dicom_files(spark: SparkSession, root: str) -> DataFrame:
    """Files with a DICOM extension, or without one but with the magic bytes."""
    rows = files(spark, root)
    name = F.element_at(F.split("path", "/"), -1)
    magic = (F.col("length") > 128) & (F.substring(F.col("content"), 129, 4) == F.lit(b"DICM"))
    return rows.where(F.lower(name).rlike(rf"\.({KINDS['dicom']})$") | (~name.contains(".") & magic))


def folders(df: DataFrame, path: str = "path") -> DataFrame:
    """The distinct folders that directly hold the files."""
    return df.select(F.regexp_replace(path, "/[^/]*$", "").alias("folder")).distinct()


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)(?:\.gz)?$", 1))


def kind(path: Column) -> Column:
    out = F.lit("other")
    for k, ends in KINDS.items():
        out = F.when(extension(path).rlike(f"^({ends})$"), k).otherwise(out)
    return out


def hidden(path: Column) -> Column:
    """Some folder or the file itself starts with a dot or is called _internal."""
    return path.rlike(r"(^|/)(\.[^/]|_internal(/|$))")


def matches_any(path: Column, globs: list[str]) -> Column:
    """The path, or its last part, fits one of the globs (* and ? as in file names, over any folders)."""
    pattern = "|".join("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in g) for g in globs)
    return path.rlike(rf"^(?:.*/)?(?:{pattern})$") if globs else F.lit(False)


def text_metadata(text: Column) -> dict[str, Column]:
    """Characters, lines and words."""
    return {"n_chars": F.char_length(text), "n_lines": F.regexp_count(text, F.lit("\n")) + 1, "n_words": F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))}


def csv_metadata(text: Column) -> dict[str, Column]:
    """Columns of the header, rows below it."""
    lines = F.filter(F.split(text, "\r?\n"), lambda x: x != "")
    return {"columns": F.split(F.try_element_at(lines, F.lit(1)), ","), "n_rows": F.greatest(F.size(lines) - 1, F.lit(0))}


def json_metadata(text: Column) -> dict[str, Column]:
    """Top-level type, at most 20 keys, length."""
    top = F.regexp_replace(F.schema_of_variant(F.try_parse_json(text)), "<.*", "")
    return {"json_type": top, "json_keys": F.slice(F.json_object_keys(text), 1, 20), "json_length": F.coalesce(F.json_array_length(text), F.size(F.json_object_keys(text)))}


def describe(df: DataFrame) -> DataFrame:
    """The inventory: path, bytes, kind and the metadata of text-like files, sorted by path."""
    text = F.when(F.col("kind").isin("text", "csv", "json"), F.decode("content", "utf-8"))
    rows = df.select("path", F.col("length").alias("bytes"), kind(F.col("path")).alias("kind"), "content").withColumn("_text", text).drop("content")
    cols = {n: F.when(F.col("kind") == k, c) for k, make in (("text", text_metadata), ("csv", csv_metadata), ("json", json_metadata)) for n, c in make(F.col("_text")).items()}
    return rows.withColumns(cols).drop("_text").orderBy("path")


def _headers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(p, *_header(c)) for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        path, form, shape, spacing = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(form, pa.string()), pa.array(shape, pa.list_(pa.int64())), pa.array(spacing, pa.list_(pa.float64()))], names=["path", "format", "shape", "spacing"])


def _header(content: bytes) -> tuple[str | None, list[int] | None, list[float] | None]:
    """Format, shape and spacing from the first bytes of a NIfTI-1, PNG or GIF file."""
    for order in "<>":
        if len(content) >= 348 and struct.unpack_from(order + "i", content)[0] == 348:
            n, *dims = struct.unpack_from(order + "8h", content, 40)
            return "NIfTI", dims[:n], list(struct.unpack_from(order + "8f", content, 76)[1 : n + 1])
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return "PNG", list(struct.unpack_from(">2I", content, 16)), None
    if content[:3] == b"GIF":
        return "GIF", list(struct.unpack_from("<2H", content, 6)), None
    return None, None, None


def binary_headers(df: DataFrame) -> DataFrame:
    """path, format, shape, spacing of image and NIfTI files."""
    return df.select("path", F.substring(F.col("content"), 1, 352).alias("content")).mapInArrow(_headers, "path string, format string, shape array<long>, spacing array<double>")
