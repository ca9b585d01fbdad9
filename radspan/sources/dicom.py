"""DICOM headers as rows: a reader of the file format (little-endian, explicit or implicit) that stops at the pixel data.

A file is looked at through a Window, which fetches blocks where the parser asks for them: values that are not wanted
are skipped, not fetched, so what is read of a file is bounded by its header. headers() and tag_rows() take any table of
files (path, and content or not); the data source "dicom" (dicom_source) plans files of a folder by itself.

Defined cases: a file that cannot be read has no tags and an error; one that holds a tag twice keeps the first value and has
an error that names the tag; values of unknown or binary representation are "<bytes:n>", sequences "<sequence:n items>".
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.functions.exports import SYNTAX_NAMES, lookup
from radspan.sources.scratch import spread

# fixed values: keywords of the tags that the operators use
KEYWORDS = {
    (0x0008, 0x0016): "SOPClassUID", (0x0008, 0x0018): "SOPInstanceUID", (0x0008, 0x0020): "StudyDate", (0x0008, 0x0030): "StudyTime", (0x0008, 0x0060): "Modality", (0x0008, 0x0070): "Manufacturer",
    (0x0008, 0x0080): "InstitutionName", (0x0008, 0x1030): "StudyDescription", (0x0008, 0x103E): "SeriesDescription", (0x0010, 0x0010): "PatientName", (0x0010, 0x0020): "PatientID", (0x0010, 0x0030): "PatientBirthDate",
    (0x0010, 0x0040): "PatientSex", (0x0010, 0x1010): "PatientAge", (0x0018, 0x0050): "SliceThickness", (0x0018, 0x0080): "RepetitionTime", (0x0018, 0x0081): "EchoTime", (0x0018, 0x0082): "InversionTime",
    (0x0018, 0x0087): "MagneticFieldStrength", (0x0018, 0x0088): "SpacingBetweenSlices", (0x0018, 0x1314): "FlipAngle", (0x0018, 0x9087): "DiffusionBValue", (0x0020, 0x000D): "StudyInstanceUID", (0x0020, 0x000E): "SeriesInstanceUID",
    (0x0020, 0x0011): "SeriesNumber", (0x0020, 0x0013): "InstanceNumber", (0x0020, 0x0032): "ImagePositionPatient", (0x0020, 0x0037): "ImageOrientationPatient", (0x0028, 0x0004): "PhotometricInterpretation",
    (0x0028, 0x0010): "Rows", (0x0028, 0x0011): "Columns", (0x0028, 0x0030): "PixelSpacing", (0x0028, 0x0100): "BitsAllocated",
    (0x0008, 0x0005): "SpecificCharacterSet", (0x0008, 0x1010): "StationName", (0x0008, 0x1090): "ManufacturerModelName", (0x0010, 0x1030): "PatientWeight", (0x0018, 0x1020): "SoftwareVersions", (0x0028, 0x1052): "RescaleIntercept", (0x0028, 0x1053): "RescaleSlope",
    (0x0002, 0x0002): "MediaStorageSOPClassUID", (0x0002, 0x0003): "MediaStorageSOPInstanceUID", (0x0002, 0x0010): "TransferSyntaxUID", (0x0002, 0x0012): "ImplementationClassUID",
}
# fixed values: representations with a 32-bit length, numbers, and the uncompressed syntaxes
LONG = {"OB", "OD", "OF", "OL", "OV", "OW", "SQ", "SV", "UC", "UN", "UR", "UT", "UV"}
NUMBERS = {"US": "H", "SS": "h", "UL": "I", "SL": "i", "FL": "f", "FD": "d"}
IMPLICIT, BIG_ENDIAN = "1.2.840.10008.1.2", "1.2.840.10008.1.2.2"
NUMERIC_WITHOUT_VR = {"Rows": "US", "Columns": "US", "BitsAllocated": "US"}
#: representations of a 32-bit length that are text
TEXT = {"UC", "UR", "UT"}
# fixed values: character sets by their defined terms
CHARACTERS = {"ISO_IR 6": "ascii", "ISO_IR 100": "latin-1", "ISO_IR 101": "iso8859-2", "ISO_IR 109": "iso8859-3", "ISO_IR 110": "iso8859-4", "ISO_IR 144": "iso8859-5", "ISO_IR 127": "iso8859-6", "ISO_IR 126": "iso8859-7", "ISO_IR 138": "iso8859-8", "ISO_IR 148": "iso8859-9", "ISO_IR 192": "utf-8"}
TAG = "path string, tag string, keyword string, vr string, value string, meta boolean, error string"
HEADER = "path string, length long, tags map<string,string>, meta map<string,string>, has_pixel_data boolean, tag_count int, bytes_read long, error string"
OPEN = 0xFFFFFFFF
ITEM, ITEM_END, SEQUENCE_END = (0xFFFE, 0xE000), (0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)
PIXELS = (0x7FE0, 0x0008)
#: Bytes that are fetched at once.
BLOCK = 1 << 14


class Window:
    """Bytes of a file by place; fetch(at, n) is called for a block where what is asked for is not at hand."""

    def __init__(self, fetch: Callable[[int, int], bytes], size: int):
        self.fetch, self.size, self.read = fetch, size, 0
        self.start, self.block = 0, b""

    @classmethod
    def of(cls, content: bytes) -> Window:
        return cls(lambda at, n: content[at : at + n], len(content))

    def get(self, at: int, n: int) -> bytes:
        if at + n > self.size:
            raise ValueError("a value without end")
        if at < self.start or at + n > self.start + len(self.block):
            self.start, self.block = at, self.fetch(at, min(max(n, BLOCK), self.size - at))
            self.read += len(self.block)
        return self.block[at - self.start : at - self.start + n]


class Element(NamedTuple):
    tag: tuple[int, int]
    keyword: str
    vr: str
    value: str
    kind: str  # value, bytes, sequence or pixels

    @property
    def meta(self) -> bool:
        return self.tag[0] == 2

    @property
    def name(self) -> str:
        return f"({self.tag[0]:04x},{self.tag[1]:04x})"


def _value(raw: bytes, vr: str, charset: str = "utf-8") -> str:
    if vr in NUMBERS:
        size = struct.calcsize(NUMBERS[vr])
        return "\\".join(str(x[0]) for x in struct.iter_unpack("<" + NUMBERS[vr], raw[: len(raw) // size * size]))
    return raw.decode(charset, "replace").strip("\0 ")


def _element(window: Window, at: int, implicit: bool) -> tuple[tuple[int, int], str, int, int]:
    """Tag, representation, where the value starts, and its length."""
    first = window.get(at, 8)
    tag = struct.unpack_from("<2H", first)
    if tag[0] == 0xFFFE or implicit and tag[0] != 2:
        return tag, NUMERIC_WITHOUT_VR.get(KEYWORDS.get(tag, ""), ""), at + 8, struct.unpack_from("<I", first, 4)[0]
    vr = first[4:6].decode("latin-1")
    if vr in LONG:
        return tag, vr, at + 12, struct.unpack("<I", window.get(at + 8, 4))[0]
    return tag, vr, at + 8, struct.unpack_from("<H", first, 6)[0]


def _items(window: Window, at: int, implicit: bool, end: int | None = None) -> tuple[int, int]:
    """Items of the sequence that starts at `at`, and where it ends; without a given end its items are walked up to their mark."""
    depth, n_items = 1, 0
    while depth and (end is None or at < end):
        if at + 8 > window.size:
            raise ValueError("a sequence without end")
        tag, _, start, n = _element(window, at, implicit)
        if tag == SEQUENCE_END:
            depth -= 1
        n_items += tag == ITEM and depth == 1
        at = start if tag in (ITEM_END, SEQUENCE_END) or n == OPEN else start + n
        if n == OPEN and tag[0] != 0xFFFE:
            depth += 1
    if at > window.size:
        raise ValueError("a sequence without end")
    return n_items, at


def elements(window: Window, last: tuple[int, int] = PIXELS) -> Iterator[Element]:
    """The elements in file order, up to the pixel data (an element of kind "pixels" tells that there are some) or beyond `last`."""
    if window.size < 132 or window.get(128, 4) != b"DICM":
        raise ValueError("no DICOM file")
    at, implicit, charset = 132, False, "utf-8"
    while at + 8 <= window.size:
        tag, vr, at, n = _element(window, at, implicit)
        keyword = KEYWORDS.get(tag) or f"{'Meta' if tag[0] == 2 else 'Tag'}_{tag[0]:04X}_{tag[1]:04X}"
        if tag >= PIXELS:
            yield Element(tag, keyword, vr, "", "pixels")
            return
        if tag > last:
            return
        if n == OPEN or vr == "SQ" or implicit and n >= 8 and window.get(at, 4) == struct.pack("<2H", *ITEM):
            items, at = _items(window, at, implicit, None if n == OPEN else at + n)
            yield Element(tag, keyword, "SQ", f"<sequence:{items} items>", "sequence")
            continue
        if at + n > window.size:
            raise ValueError("a value without end")
        if vr in LONG - TEXT:
            yield Element(tag, keyword, vr, f"<bytes:{n}>", "bytes")
        else:
            value = _value(window.get(at, n), vr, charset)
            if tag == (2, 0x0010):
                if value == BIG_ENDIAN:
                    raise ValueError("big-endian files are not read")
                implicit = value == IMPLICIT
            elif tag == (8, 0x0005):
                charset = CHARACTERS.get(value.rsplit("\\", 1)[-1], "utf-8")
            yield Element(tag, keyword, vr, value, "value")
        at += n


def tags(content: bytes) -> Iterator[tuple[str, str | None, str, str]]:
    """(tag, keyword, representation, value) up to the pixel data; sequences and bytes are passed over."""
    for e in elements(Window.of(content)):
        if e.kind == "value":
            yield e.name, KEYWORDS.get(e.tag), e.vr, e.value


class Header(NamedTuple):
    tags: dict[str, str] | None
    meta: dict[str, str] | None
    has_pixel_data: bool | None
    tag_count: int | None
    bytes_read: int
    error: str | None


def header(window: Window, last: tuple[int, int] = PIXELS) -> Header:
    """The whole header of a file, or what makes it unreadable."""
    found, meta, pixels, twice, n = {}, {}, False, None, 0
    try:
        for e in elements(window, last):
            if e.kind == "pixels":
                pixels, n = True, n + 1
                break
            into = meta if e.meta else found
            if e.keyword in into:
                twice = twice or f"tag {e.name} is repeated"
            else:
                into[e.keyword] = e.value
            n += not e.meta
    except (ValueError, struct.error, OSError) as e:
        return Header(None, None, None, None, window.read, str(e) or type(e).__name__)
    return Header(found, meta, pixels, n, window.read, twice)


class Files:
    """Opens files of any store by their address; the handle of a store is kept."""

    def __init__(self) -> None:
        self.stores: dict[str, fs.FileSystem] = {}

    def at(self, path: str) -> tuple[fs.FileSystem, str]:
        scheme, _, rest = path.partition(":")
        if scheme == "file" or not rest:
            path = "/" + (rest or path).lstrip("/")
            return self.stores.setdefault("file", fs.LocalFileSystem()), path
        place = path.split("/", 3)[:3]
        if (key := "/".join(place)) not in self.stores:
            self.stores[key] = fs.FileSystem.from_uri(path)[0]
        return self.stores[key], path.split("://", 1)[1]

    def header(self, path: str, last: tuple[int, int] = PIXELS) -> tuple[int | None, Header]:
        """Length and header of a file; of one that cannot be opened only the error."""
        try:
            store, place = self.at(path)
            with store.open_input_file(place) as f:
                return f.size(), header(Window(lambda at, n: f.read_at(n, at), f.size()), last)
        except OSError as e:
            return None, Header(None, None, None, None, 0, str(e) or type(e).__name__)


    def elements(self, path: str, content: bytes | None, inside: bool) -> list[Element]:
        """The elements of a file at hand (`inside`), or of one at its path."""
        if inside:
            return list(elements(Window.of(content or b"")))
        store, place = self.at(path)
        with store.open_input_file(place) as f:
            return list(elements(Window(lambda at, n: f.read_at(n, at), f.size())))


def _windows(batch: pa.RecordBatch, files: Files) -> Iterator[tuple[str, int | None, Header]]:
    for i, path in enumerate(batch.column(0).to_pylist()):
        content = batch.column(1)[i].as_py() if batch.num_columns > 1 else None
        if batch.num_columns > 1:
            yield path, None if content is None else len(content), header(Window.of(content or b""))
        else:
            yield path, *files.header(path)


_MAP = pa.map_(pa.string(), pa.string())
ARROW = [("path", pa.string()), ("length", pa.int64()), ("tags", _MAP), ("meta", _MAP), ("has_pixel_data", pa.bool_()), ("tag_count", pa.int32()), ("bytes_read", pa.int64()), ("error", pa.string())]


def batch_of(rows: list[tuple[str, int | None, Header]]) -> pa.RecordBatch:
    pairs = lambda d: None if d is None else list(d.items())
    flat = [(path, length, pairs(h.tags), pairs(h.meta), *h[2:]) for path, length, h in rows]
    columns = list(zip(*flat, strict=True)) or [()] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, ARROW, strict=True)], names=[n for n, _ in ARROW])


def _headers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = Files()
    for batch in batches:
        yield batch_of(list(_windows(batch, files)))


def _given(files: DataFrame) -> DataFrame:
    return files.select("path", "content") if "content" in files.columns else spread(files.select("path"), "path")


def headers(files: DataFrame) -> DataFrame:
    """One row per file of files (path, and content if it is at hand): see HEADER. Contents are not shuffled: a file is one row throughout.

    Without content the paths are spread over the tasks, which open the files and fetch only their headers;
    `inventory.listed` lists files in tasks.
    """
    return _given(files).mapInArrow(_headers, HEADER)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = Files()
    for batch in batches:
        inside, rows = batch.num_columns > 1, []
        for i, path in enumerate(batch.column(0).to_pylist()):
            try:
                found = files.elements(path, batch.column(1)[i].as_py() if inside else None, inside)
                rows += [(path, e.name, e.keyword, e.vr, e.value, e.meta, None) for e in found if e.kind != "pixels"]
            except (ValueError, struct.error, OSError) as e:
                rows.append((path, None, None, None, None, None, str(e) or type(e).__name__))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.string()] * 5 + [pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in TAG.split(", ")])


def tag_rows(files: DataFrame) -> DataFrame:
    """Every element of files (path, and content if it is at hand) as a row, those of the file's own meta group and repeated ones too.

    Without content only the headers are fetched, as in headers()."""
    return _given(files).mapInArrow(_scan, TAG)


# fixed values: names of the flat record of a file, each with its keyword and what stands for a missing one
RECORD_TEXT = {
    "_series_uid": ("SeriesInstanceUID", "unknown"), "_series_number": ("SeriesNumber", ""), "_series_description": ("SeriesDescription", ""), "_modality": ("Modality", ""), "_sop_class_uid": ("SOPClassUID", ""),
    "_patient_id": ("PatientID", ""), "_patient_name": ("PatientName", ""), "_patient_sex": ("PatientSex", ""), "_patient_birth_date": ("PatientBirthDate", ""), "_patient_weight": ("PatientWeight", ""),
    "_study_date": ("StudyDate", ""), "_study_description": ("StudyDescription", ""), "_institution": ("InstitutionName", ""), "_manufacturer": ("Manufacturer", ""), "_model": ("ManufacturerModelName", ""),
    "_field_strength": ("MagneticFieldStrength", ""), "_software_versions": ("SoftwareVersions", ""), "_station_name": ("StationName", ""),
}
TIMING = {"tr": "RepetitionTime", "te": "EchoTime", "ti": "InversionTime", "fa": "FlipAngle", "b_value": "DiffusionBValue"}
LIGHT = ("_series_uid", "_series_number", "_series_description", "_modality", "_sop_class_uid", "_patient_id", "_patient_name", "_study_date", "_institution")
UNIVERSAL = {"dicom_patient_id": "PatientID", "dicom_patient_name": "PatientName", "dicom_study_date": "StudyDate", "dicom_modality": "Modality", "dicom_series_uid": "SeriesInstanceUID", "dicom_series_number": "SeriesNumber", "dicom_series_description": "SeriesDescription", "dicom_institution": "InstitutionName", "dicom_manufacturer": "Manufacturer", "dicom_sop_class_uid": "SOPClassUID"}


def _tag(keyword: str) -> Column:
    return F.try_element_at("tags", F.lit(keyword))


def _whole(keyword: str) -> Column:
    return F.coalesce(_tag(keyword).try_cast("int"), F.lit(0))


def _file() -> list[Column]:
    return [F.element_at(F.split("path", "/"), -1).alias("_filename"), F.col("path").alias("_filepath")]


def record(headers: DataFrame) -> DataFrame:
    """The flat record of each readable file, beside its map of tags: identity, patient, scanner, timing, place."""
    at = F.split(_tag("ImagePositionPatient"), r"\\")
    meta = lambda k: F.coalesce(F.try_element_at("meta", F.lit(k)), F.lit(""))
    return headers.where("tags IS NOT NULL").select(
        *_file(),
        F.col("length").alias("_file_size_bytes"),
        F.col("has_pixel_data").alias("_has_pixel_data"),
        meta("TransferSyntaxUID").alias("_transfer_syntax_uid"),
        lookup(meta("TransferSyntaxUID"), SYNTAX_NAMES).alias("_transfer_syntax_name"),
        meta("MediaStorageSOPClassUID").alias("_media_storage_sop_class"),
        *[F.coalesce(_tag(k), F.lit(none)).alias(n) for n, (k, none) in RECORD_TEXT.items()],
        *[_tag(k).try_cast("double").alias(f"_{n}") for n, k in TIMING.items()],
        F.when(F.size(at) >= 3, F.get(at, F.lit(2)).try_cast("double")).alias("_z_position"),
        _whole("InstanceNumber").alias("_instance_number"),
        "tags",
    )


def light_record(headers: DataFrame) -> DataFrame:
    """The record that messages carry."""
    return record(headers).select("_filename", "_filepath", "_has_pixel_data", *LIGHT, *[f"_{n}" for n in TIMING], "_instance_number", "tags")


def universal_record(headers: DataFrame) -> DataFrame:
    """The figures of a file for an inventory of all kinds of files; unreadable ones have their error."""
    text = lambda k: F.when(F.col("tags").isNotNull(), F.coalesce(_tag(k), F.lit("")))
    number = lambda k: F.when(F.col("tags").isNotNull(), _whole(k))
    return headers.select(
        "path",
        F.when(F.col("tags").isNull(), "dicom_error").otherwise("dicom").alias("file_type"),
        *[text(k).alias(n) for n, k in UNIVERSAL.items()],
        *[number(k).alias(n) for n, k in (("dicom_rows", "Rows"), ("dicom_columns", "Columns"), ("dicom_instance_number", "InstanceNumber"))],
        *[_tag(k).try_cast("double").alias(f"dicom_{n}") for n, k in TIMING.items()],
        _tag("SliceThickness").try_cast("double").alias("dicom_slice_thickness"),
        "has_pixel_data",
        F.col("tag_count").alias("dicom_tag_count"),
        "error",
    )


def series(headers: DataFrame) -> DataFrame:
    """One row per series: identity and timing of its first file by name, and its files in slice order."""
    t = lambda k: F.try_element_at("tags", F.lit(k))
    z = F.element_at(F.split(t("ImagePositionPatient"), r"\\"), -1).try_cast("double")
    order = F.struct(F.coalesce(z, F.lit(float("inf"))).alias("z"), F.coalesce(t("InstanceNumber").try_cast("int"), F.lit(1 << 30)).alias("i"), F.col("path"))
    names = {"series_number": "SeriesNumber", "series_description": "SeriesDescription", "modality": "Modality", "tr_ms": "RepetitionTime", "te_ms": "EchoTime", "ti_ms": "InversionTime", "fa_deg": "FlipAngle", "b_value": "DiffusionBValue"}
    out = headers.where("tags is not null").groupBy(t("StudyInstanceUID").alias("study_id"), t("SeriesInstanceUID").alias("series_uid"))
    return out.agg(F.count("*").alias("file_count"), *[F.min_by(t(k), "path").alias(n) for n, k in names.items()], F.transform(F.array_sort(F.collect_list(order)), lambda x: x["path"]).alias("file_paths"))
