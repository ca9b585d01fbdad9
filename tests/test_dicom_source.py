"""The header source: bytes that are fetched, files that are chosen, and what cannot be read."""

import os
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith
from pyspark.sql.types import StructType

from radspan.sources import dicom, dicom_files, dicom_source

PLAIN = [("PatientID", "P1"), ("SeriesDescription", "Ax T2"), ("SeriesInstanceUID", "1.2.3"), ("EchoTime", "95.5"), ("Rows", "256"), ("ImagePositionPatient", "0\\0\\-4.5"), ("InstanceNumber", "7")]


def _large(path, size):
    """A file whose pixel data is `size` bytes long, without writing them."""
    content = dicom_files.encoded(PLAIN) + struct.pack("<2H2s2xI", 0x7FE0, 0x0010, b"OW", size)
    path.write_bytes(content)
    os.truncate(path, len(content) + size)


def test_only_headers_are_fetched(spark, tmp_path):
    _large(tmp_path / "a.dcm", 200 << 20)
    dicom_source.register(spark)
    row = spark.read.format("dicom").load(str(tmp_path)).first()
    assert row.has_pixel_data and row.tags["Rows"] == "256" and row.length > 200 << 20
    assert row.bytes_read <= 2 * dicom.BLOCK
    listed = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    assert dicom.headers(listed).first().bytes_read <= 2 * dicom.BLOCK


def test_large_values_that_nobody_reads_are_skipped():
    big = dicom_files.element((0x0009, 0x1001), "OB", b"\1" * 300_000)
    content = dicom_files.encoded([("Modality", "MR")]) + big + dicom_files.element((0x0010, 0x0020), "LO", b"P2")
    window = dicom.Window.of(content)
    head = dicom.header(window)
    assert head.tags == {"Modality": "MR", "Tag_0009_1001": "<bytes:300000>", "PatientID": "P2"} and window.read < 3 * dicom.BLOCK


def test_named_columns_stop_at_the_last_of_them():
    content = dicom_files.encoded(PLAIN)
    reader = dicom_source.HeaderReader({"path": "/x"}, StructType.fromDDL("path string, PatientID string, SeriesDescription string"))
    assert reader.last == (0x0010, 0x0020)
    assert "Rows" not in dicom.header(dicom.Window.of(content), reader.last).tags
    assert dicom_source.HeaderReader({"path": "/x"}, StructType.fromDDL(dicom.HEADER)).last == dicom.PIXELS
    with pytest.raises(ValueError, match="no column"):
        dicom_source.HeaderReader({"path": "/x"}, StructType.fromDDL("Nonsense string"))


def test_a_repeated_tag_is_a_row_with_an_error(spark, tmp_path):
    (tmp_path / "a.dcm").write_bytes(dicom_files.encoded([*PLAIN, ("PatientID", "P2")]))
    (tmp_path / "b.dcm").write_bytes(dicom_files.encoded(PLAIN, implicit=True))
    (tmp_path / "c.dcm").write_bytes(b"short")
    (tmp_path / "other").write_bytes(b"x" * 200)
    (tmp_path / "d.txt").write_text("no")
    (tmp_path / "empty.dcm").write_bytes(b"")
    dicom_source.register(spark)
    want = {"a.dcm": ("P1", "tag (0010,0020) is repeated"), "b.dcm": ("P1", None), "c.dcm": (None, "no DICOM file"), "empty.dcm": (None, "no DICOM file")}
    rows = spark.read.format("dicom").load(str(tmp_path))
    assert {r.path.rsplit("/", 1)[1]: ((r.tags or {}).get("PatientID"), r.error) for r in rows.collect()} == want
    files = spark.read.format("binaryFile").load(str(tmp_path)).where("path LIKE '%.dcm'")
    del want["empty.dcm"]  # Spark's reader lists no empty files
    assert {r.path.rsplit("/", 1)[1]: ((r.tags or {}).get("PatientID"), r.error) for r in dicom.headers(files).collect()} == want
    plan = dicom.headers(files)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_filters_choose_files_before_they_are_opened(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"s{i}").mkdir()
        (tmp_path / f"s{i}/f.dcm").write_bytes(dicom_files.encoded(PLAIN, pixels=1000 * i))
    reader = dicom_source.HeaderReader({"path": str(tmp_path)}, StructType.fromDDL(dicom.HEADER))
    left = list(reader.pushFilters([StringStartsWith(("path",), f"file://{tmp_path}/s"), GreaterThan(("length",), 1500), EqualTo(("error",), "x")]))
    assert left == [EqualTo(("error",), "x")]
    assert [p.rsplit("/", 2)[1] for part in reader.partitions() for p in part.paths] == ["s2", "s3"]
    dicom_source.register(spark)
    rows = spark.read.format("dicom").load(str(tmp_path)).where(F.col("path").isin(f"file://{tmp_path}/s1/f.dcm", "y"))
    assert [r.path for r in rows.collect()] == [f"file://{tmp_path}/s1/f.dcm"]
    assert "PythonScan" in (plan := rows._jdf.queryExecution().executedPlan().toString()) or "BatchScan" in plan
    assert list(reader.pushFilters([In(("path",), ("a",))])) == []


def test_partitions_are_planned_by_bytes():
    files = [(f"f{i}", 1 << 30) for i in range(100)]
    runs = dicom_source.planned(files, 16 << 20)
    assert [p for r in runs for p in r] == [p for p, _ in files]
    assert {len(r) for r in runs[:-1]} == {(16 << 20) // (dicom_source.OPEN_COST + dicom_source.HEADER_BYTES)}


def test_typed_columns(spark, tmp_path):
    (tmp_path / "a.dcm").write_bytes(dicom_files.encoded([*PLAIN[:3], ("EchoTime", "none"), ("Rows", "12")]))
    dicom_source.register(spark)
    got = spark.read.format("dicom").schema("Rows int, EchoTime double, TransferSyntaxUID string").load(str(tmp_path)).first()
    assert tuple(got) == (12, None, dicom_files.EXPLICIT)


def test_sequences_bytes_and_meta_are_told(spark):
    item = struct.pack("<2HI", 0xFFFE, 0xE000, 4) + b"abcd"
    open_item = struct.pack("<2HI", 0xFFFE, 0xE000, 0xFFFFFFFF) + dicom_files.element((8, 0x100), "SH", b"in") + struct.pack("<2HI", 0xFFFE, 0xE00D, 0)
    known = struct.pack("<2H2s2xI", 8, 0x1140, b"SQ", 2 * len(item)) + item * 2
    unknown = struct.pack("<2H2s2xI", 8, 0x1115, b"SQ", 0xFFFFFFFF) + open_item * 3 + struct.pack("<2HI", 0xFFFE, 0xE0DD, 0)
    content = dicom_files.encoded([("Modality", "MR")]) + unknown + known + dicom_files.element((0x10, 0x10), "PN", b"A^B")
    rows = [tuple(r)[1:] for r in dicom.tag_rows(spark.createDataFrame([("f", bytearray(content))], "path string, content binary")).collect()]
    assert rows == [
        ("(0002,0010)", "TransferSyntaxUID", "UI", dicom_files.EXPLICIT, True, None),
        ("(0008,0060)", "Modality", "LO", "MR", False, None),
        ("(0008,1115)", "Tag_0008_1115", "SQ", "<sequence:3 items>", False, None),
        ("(0008,1140)", "Tag_0008_1140", "SQ", "<sequence:2 items>", False, None),
        ("(0010,0010)", "PatientName", "PN", "A^B", False, None),
    ]
    for cut in (len(content) - 3, content.index(known) + 15, content.index(unknown) + 30):
        assert dicom.header(dicom.Window.of(content[:cut])).tags is None


def test_character_sets(spark):
    content = dicom_files.encoded([("SpecificCharacterSet", "ISO_IR 100")]) + dicom_files.element((0x10, 0x10), "PN", "Müller".encode("latin-1"))
    assert dicom.header(dicom.Window.of(content)).tags["PatientName"] == "Müller"


def test_records(spark):
    content = dicom_files.encoded(PLAIN, pixels=10)
    files = spark.createDataFrame([("/d/a.dcm", bytearray(content)), ("/d/b.dcm", bytearray(b"bad")), ("/d/c.dcm", None)], "path string, content binary")
    heads = dicom.headers(files)
    row = dicom.record(heads).collect()
    assert len(row) == 1 and (row[0]._filename, row[0]._te, row[0]._z_position, row[0]._instance_number, row[0]._tr, row[0]._modality, row[0]._has_pixel_data) == ("a.dcm", 95.5, -4.5, 7, None, "", True)
    assert dicom.light_record(heads).first()._series_uid == "1.2.3"
    kinds = {r.path: (r.file_type, r.dicom_rows, r.dicom_tag_count) for r in dicom.universal_record(heads).collect()}
    assert kinds == {"/d/a.dcm": ("dicom", 256, 8), "/d/b.dcm": ("dicom_error", None, None), "/d/c.dcm": ("dicom_error", None, None)}


def test_tag_rows_of_paths(spark, tmp_path):
    good = dicom_files.encoded([("PatientID", "p"), ("Rows", "3")], pixels=1 << 16)
    rows = [(str(tmp_path / "a.dcm"), good), (str(tmp_path / "b.dcm"), b"none")]
    for path, content in rows:
        open(path, "wb").write(content)
    files = spark.createDataFrame(rows, "path string, content binary")
    ours, theirs = dicom.tag_rows(files.select("path")), dicom.tag_rows(files)
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect())) and ours.count() == 4
    lost = dicom.tag_rows(spark.createDataFrame([(str(tmp_path / "c.dcm"),)], "path string")).first()
    assert lost["tag"] is None and lost["error"]
    assert ours.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism  # rows of few bytes, each a file to open


def test_a_long_list_makes_few_partitions():
    paths = [f"file:///root/study{i % 13}/f{i}.dcm" for i in range(5000)]
    part = dicom_source.FilesOf.of(paths)
    assert part.paths == paths and len(part.packed) * 5 < sum(map(len, paths))


def test_partitions_are_bounded(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / f"f{i}.dcm").write_bytes(b"none")
    monkeypatch.setattr(dicom_source, "PARTITIONS", 4)
    monkeypatch.setattr(dicom_source, "PARTITION_BYTES", 1 << 18)
    reader = dicom_source.HeaderReader({"path": str(tmp_path)}, StructType.fromDDL("path string"))
    parts = reader.partitions()
    assert len(parts) <= 8 and sum(len(p.paths) for p in parts) == 40
