"""DICOM files written from rows: one file a row, for exports and round trips."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from radspan.sources.dicom import IMPLICIT, KEYWORDS, LONG, NUMBERS, NUMERIC_WITHOUT_VR, Files

EXPLICIT = "1.2.840.10008.1.2.1"


def element(tag: tuple[int, int], vr: str, value: bytes, implicit: bool = False) -> bytes:
    """One element; values of odd length are padded."""
    value += (b"\0" if vr in ("UI", "OB") else b" ") * (len(value) % 2)
    if implicit and tag[0] != 2:
        return struct.pack("<2HI", *tag, len(value)) + value
    if vr in LONG:
        return struct.pack("<2H2s2xI", *tag, vr.encode(), len(value)) + value
    return struct.pack("<2H2sH", *tag, vr.encode(), len(value)) + value


def encoded(values: list[tuple[str, str]], pixels: int = 0, implicit: bool = False) -> bytes:
    """A file of (keyword, value) in the order of their tags, with so many bytes of pixel data."""
    places = {k: t for t, k in KEYWORDS.items()}
    body = b""
    for keyword, value in sorted(values, key=lambda x: places[x[0]]):
        vr = NUMERIC_WITHOUT_VR.get(keyword) or ("UI" if keyword.endswith("UID") else "LO")
        raw = struct.pack("<" + NUMBERS[vr], int(value)) if vr in NUMBERS else value.encode()
        body += element(places[keyword], vr, raw, implicit)
    body += element((0x7FE0, 0x0010), "OW", bytes(pixels), implicit) if pixels else b""
    return b"\0" * 128 + b"DICM" + element((2, 0x0010), "UI", (IMPLICIT if implicit else EXPLICIT).encode()) + body


def _put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files, made = Files(), set()
    for batch in batches:
        paths, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for path, content in zip(paths, contents, strict=True):
            store, place = files.at(path)
            if (folder := path.rsplit("/", 1)[0]) not in made:
                store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                made.add(folder)
            with store.open_output_stream(place) as out:
                out.write(content)
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array([len(c) for c in contents], pa.int64())], names=["path", "length"])


def write_files(files: DataFrame) -> DataFrame:
    """Writes content to path, for each row of files (path, content), when the result (path, length) is asked for. A task that runs
    again writes the same files again."""
    return files.select("path", "content").mapInArrow(_put, "path string, length long")
