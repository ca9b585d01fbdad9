"""The data source "dicom": headers of the files below a folder, planned by bytes, fetched up to the pixel data.

    dicom_source.register(spark)
    spark.read.format("dicom").load(root)                                    # dicom.HEADER
    spark.read.format("dicom").schema("path string, EchoTime double").load(root)

A schema of the caller's names keywords as columns; then files are read no further than the last tag that it names (tags
ascend). Filters on path and length choose files before any is opened. Options: pathGlobFilter (on names),
partitionBytes. Up to LISTED files are planned by their paths and lengths. Of more the driver only counts the names, one
after the other, and keeps the folders: tasks list them, those of a large folder each for its share of the names (at most
SHARERS tasks a folder, also where partitionBytes asks for more). A store other than the local one gives the names of a
folder at once; inventory.listed has it listed in tasks, for dicom.headers().
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith

from radspan.sources.dicom import ARROW, HEADER, KEYWORDS, PIXELS, Files, Header, batch_of
from radspan.sources.inventory import KINDS

#: Cost of opening a file, and the most that a header is thought to take, in bytes; files of a batch.
OPEN_COST, HEADER_BYTES, BATCH = 1 << 18, 1 << 16, 1024
#: Bytes of a partition where the caller names none, or more, so that no listing makes more than so many partitions.
PARTITION_BYTES, PARTITIONS = 64 << 20, 2000
#: Files that the driver holds by their paths at most; tasks that share a folder at most, as each of them lists all its names.
LISTED, SHARERS = 100_000, 32
_CASTS = {"string": (pa.string(), str), "int": (pa.int32(), int), "bigint": (pa.int64(), int), "float": (pa.float32(), float), "double": (pa.float64(), float)}
_TESTS = {
    EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v), StringContains: lambda x, v: v in x,
    GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
}
_FIXED = [n for n, _ in ARROW]
_ENDS = set(KINDS["dicom"].split("|"))


@dataclass
class FilesOf(InputPartition):
    """Paths of a partition, packed: they pass the driver, and sorted ones share most of their characters."""

    packed: bytes

    @classmethod
    def of(cls, paths: list[str]) -> FilesOf:
        return cls(zlib.compress(json.dumps(paths).encode()))

    @property
    def paths(self) -> list[str]:
        return json.loads(zlib.decompress(self.packed))


@dataclass
class FoldersOf(InputPartition):
    """Folders of a partition, in packed runs, and which share of their files is its own."""

    packed: list[bytes]
    share: int = 0
    shares: int = 1

    @property
    def folders(self) -> Iterator[str]:
        for run in self.packed:
            yield from json.loads(zlib.decompress(run))


def _entries(store: fs.FileSystem, folder: str, share: int = 0, shares: int = 1) -> Iterator[tuple[str, bool, os.DirEntry | fs.FileInfo]]:
    """Names of what a folder holds, or of a share of it, and whether it is a folder; local ones are not gathered."""
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for e in found:
                if (shares == 1 or _share(e.name, shares) == share) and ((below := e.is_dir()) or e.is_file()):
                    yield e.name, below, e
    else:
        for e in store.get_file_info(fs.FileSelector(folder)):
            if (shares == 1 or _share(e.base_name, shares) == share) and e.type in (fs.FileType.Directory, fs.FileType.File):
                yield e.base_name, e.type == fs.FileType.Directory, e


def _share(name: str, shares: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogateescape")) % shares


def _length(entry: os.DirEntry | fs.FileInfo) -> int | None:
    """Of a file that is gone by now, nothing."""
    try:
        return (entry.size or 0) if isinstance(entry, fs.FileInfo) else entry.stat().st_size
    except FileNotFoundError:
        return None


def _below(folder: str, name: str) -> str:
    return f"{folder}{name}" if not folder or folder.endswith("/") else f"{folder}/{name}"


def _cast(value: str | None, how) -> object:
    try:
        return None if value is None else how(value)
    except ValueError:
        return None


def planned(found: list[tuple[str, int]], size: int) -> list[list[str]]:
    """Runs of files, in the order given, that cost about `size` bytes each."""
    out: list[list[str]] = []
    left = 0
    for path, length in found:
        cost = OPEN_COST + min(length, HEADER_BYTES)
        if not out or cost > left:
            out.append([])
            left = size
        out[-1].append(path)
        left -= cost
    return out


class HeaderReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.root, self.glob, self.size = options["path"], options.get("pathglobfilter"), int(options.get("partitionbytes", 0))
        self.fields = [(f.name, f.dataType.simpleString()) for f in schema]
        tags = {k: t for t, k in KEYWORDS.items()}
        for name, kind in self.fields:
            if name not in _FIXED and (name not in tags or kind not in _CASTS):
                raise ValueError(f"no column {name} {kind}: a column is one of {_FIXED}, or a known keyword of type {sorted(_CASTS)}")
        open_ended = {"tags", "meta", "has_pixel_data", "tag_count"} & {n for n, _ in self.fields}
        self.last = PIXELS if open_ended else max([(2, 0xFFFF), *[tags[n] for n, _ in self.fields if n in tags]])
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _TESTS and f.attribute in (("path",), ("length",)):
                self.tests.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, place = Files().at(self.root)
        rows = list(islice(self._files(store, place), LISTED + 1))
        if len(rows) > LISTED:
            del rows
            return self._dealt(self._counted(store, place))
        rows.sort()
        size = self.size or max(PARTITION_BYTES, sum(OPEN_COST + min(n, HEADER_BYTES) for _, n in rows) // PARTITIONS)
        return [FilesOf.of(p) for p in planned(rows, size)] or [FilesOf.of([])]

    def _dealt(self, counted: Iterable[tuple[str, int]]) -> list[InputPartition]:
        """Partitions of folders with so many files: runs of small folders, and shares of one that is larger than a partition."""
        least = max(1, (self.size or PARTITION_BYTES) // (OPEN_COST + HEADER_BYTES))
        runs: list[tuple[bytes, int]] = []
        names, n = [], 0
        for folder, files in counted:
            if names and n + files > least:
                runs.append((zlib.compress(json.dumps(names).encode()), n))
                names, n = [], 0
            names.append(folder)
            n += files
        runs.append((zlib.compress(json.dumps(names).encode()), n))
        most = least if self.size else max(least, sum(n for _, n in runs) // PARTITIONS)
        out, left = [], 0
        for run, n in runs:
            if n > most:  # one folder
                shares = min(SHARERS, -(-n // most))
                out += [FoldersOf([run], share, shares) for share in range(shares)]
                left = 0
                continue
            if not out or n > left:
                out.append(FoldersOf([]))
                left = most
            out[-1].packed.append(run)
            left -= n
        return out

    def _counted(self, store: fs.FileSystem, folder: str) -> Iterator[tuple[str, int]]:
        """Folders and how many files they hold by their paths; no name is kept."""
        n = 0
        for name, below, _ in _entries(store, folder):
            if below:
                yield from self._counted(store, _below(folder, name))
            else:
                n += self._named(name) and (not self.tests or self._chosen("path", self._path(store, folder, name)))
        if n:
            yield folder, n

    def _files(self, store: fs.FileSystem, folder: str, share: int = 0, shares: int = 1, deep: bool = True) -> Iterator[tuple[str, int]]:
        """Path and length of the files of a folder, or of a share of them, and if it goes deep of all folders below."""
        for name, below, entry in _entries(store, folder, share, shares):
            if below:
                if deep:
                    yield from self._files(store, _below(folder, name))
            elif self._named(name):
                path = self._path(store, folder, name)
                if self._chosen("path", path) and (length := _length(entry)) is not None and self._chosen("length", length):
                    yield path, length

    def _path(self, store: fs.FileSystem, folder: str, name: str) -> str:
        return ("file://" if isinstance(store, fs.LocalFileSystem) else self.root.split("://", 1)[0] + "://") + _below(folder, name)

    def _chosen(self, column: str, value: object) -> bool:
        return all(_TESTS[t](value, v) for c, t, v in self.tests if c == column)

    def _named(self, name: str) -> bool:
        end = name.rsplit(".", 1)[-1].lower() if "." in name else ""
        return (not end or end in _ENDS) and (self.glob is None or fnmatch(name, self.glob))

    def _paths(self, partition: FilesOf | FoldersOf) -> Iterator[str]:
        if isinstance(partition, FilesOf):
            yield from partition.paths
            return
        store, _ = Files().at(self.root)
        for folder in partition.folders:
            for path, _ in self._files(store, folder, partition.share, partition.shares, deep=False):
                yield path

    def read(self, partition: FilesOf | FoldersOf) -> Iterator[pa.RecordBatch]:
        files, rows = Files(), []
        for path in self._paths(partition):
            length, head = files.header(path, self.last)
            if "." not in path.rsplit("/", 1)[-1] and head.error == "no DICOM file":
                continue  # a file of another kind
            rows.append((path, length, head))
            if len(rows) >= BATCH:
                yield self._batch(rows)
                rows = []
        yield self._batch(rows)

    def _batch(self, rows: list[tuple[str, int | None, Header]]) -> pa.RecordBatch:
        whole, columns = batch_of(rows), []
        for name, kind in self.fields:
            if name in _FIXED:
                columns.append(whole.column(_FIXED.index(name)))
            else:
                arrow, how = _CASTS[kind]
                columns.append(pa.array([_cast((h.tags or {}).get(name, (h.meta or {}).get(name)), how) for _, _, h in rows], arrow))
        return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in self.fields])


class HeaderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dicom"

    def schema(self) -> str:
        return HEADER

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return HeaderReader({k.lower(): v for k, v in self.options.items()}, schema)


def register(spark: SparkSession) -> None:
    """Makes the source known to the session, and lets Python sources see filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(HeaderSource)
