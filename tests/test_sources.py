"""Readers and writers on hand-made files, and the streaming forms."""

import json
import sqlite3
import struct
import tarfile
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from radspan.sources import detail_json, dicom, inventory, sinks
from radspan.streaming import windows


def element(group, tag, vr, value, implicit=False):
    value = value + b"\0" if len(value) % 2 else value
    if implicit:
        return struct.pack("<2HI", group, tag, len(value)) + value
    if vr in dicom.LONG:
        return struct.pack("<2H2s2xI", group, tag, vr.encode(), len(value)) + value
    return struct.pack("<2H2sH", group, tag, vr.encode(), len(value)) + value


def dicom_file(uid, number, z, implicit=False, extra=b""):
    syntax = b"1.2.840.10008.1.2" if implicit else b"1.2.840.10008.1.2.1"
    e = lambda *a: element(*a, implicit)
    body = e(8, 0x60, "CS", b"MR") + e(8, 0x103E, "LO", b"Ax T2") + e(0x10, 0x20, "LO", b"P1") + e(0x18, 0x80, "DS", b"6500") + e(0x20, 0xD, "UI", b"1.2") + e(0x20, 0xE, "UI", uid) + e(0x20, 0x13, "IS", str(number).encode()) + e(0x20, 0x32, "DS", f"0\\0\\{z}".encode()) + extra + e(0x28, 0x10, "US", struct.pack("<H", 256))
    return b"\0" * 128 + b"DICM" + element(2, 0x10, "UI", syntax) + body + element(0x7FE0, 0x10, "OW", b"\1" * 10, implicit)


def test_dicom(spark, tmp_path):
    (tmp_path / "s").mkdir()
    sequence = struct.pack("<2H2s2xI", 0x28, 0x3, b"SQ", 0xFFFFFFFF) + b"\xfe\xff\x00\xe0\x04\0\0\0abcd" + b"\xfe\xff\xdd\xe0\0\0\0\0"
    (tmp_path / "s/a.dcm").write_bytes(dicom_file(b"1.2.3", 2, 5.0))
    (tmp_path / "s/b.DCM").write_bytes(dicom_file(b"1.2.3", 1, -5.0, implicit=True))
    (tmp_path / "s/plain").write_bytes(dicom_file(b"1.2.4", 1, 0.0, extra=sequence))
    (tmp_path / "s/bad.dcm").write_bytes(b"no")
    (tmp_path / "s/x.txt").write_text("text")
    files = inventory.dicom_files(spark, str(tmp_path))
    assert files.count() == 4 and inventory.folders(files).count() == 1
    heads = dicom.headers(files)
    tags = {r.path.rsplit("/", 1)[1]: (r.tags, r.error) for r in heads.collect()}
    assert tags["bad.dcm"][0] is None and "DICOM" in tags["bad.dcm"][1]
    assert all(tags[n][0]["Rows"] == "256" and tags[n][0]["PatientID"] == "P1" for n in ("a.dcm", "b.DCM", "plain"))
    series = {r.series_uid: r for r in dicom.series(heads).collect()}
    assert [p.rsplit("/", 1)[1] for p in series["1.2.3"].file_paths] == ["b.DCM", "a.dcm"] and series["1.2.4"].tr_ms == "6500"


def test_detail_json(spark, tmp_path):
    nested = {"series": {"uid": "1.2", "number": 3, "description": "Sag T1", "file_count": 5}, "sequence_classification": {"sequence_type": "T1-weighted", "confidence": "high", "parameters": {"TR_ms": 500.0}}, "volume_stats": {"quality_score": 66.0}}
    flat = {"series_uid": "1.3", "series_description": "x", "advanced_quality": {"ml_training_score": {"score": 81.0}}}
    docs = {"a": nested, "b": flat, "c": [1], "d": {"series": {"number": 1}}}
    for k, d in docs.items():
        (tmp_path / f"study/{k}").mkdir(parents=True)
        (tmp_path / f"study/{k}/{k}_detail.json").write_text(json.dumps(d))
    (tmp_path / "study/e.json").write_text('{"series": ')
    raw = detail_json.read(spark, str(tmp_path))
    got = {r.series_uid: r for r in detail_json.manifest(raw).collect()}
    assert set(got) == {"1.2", "1.3"}
    r = got["1.2"]
    assert (r.study_id, r.plane, r.tr_ms, r.quality_grade, r.sequence_type) == ("study", "sagittal", 500.0, "B", "T1-weighted")
    assert (got["1.3"].ml_grade, got["1.3"].commercial_tier, got["1.3"].sequence_confidence) == ("A", "premium", "unknown")
    assert detail_json.problems(raw).count() == 3
    run = detail_json.manifest(detail_json.arriving(spark, str(tmp_path))).writeStream.format("memory").queryName("arrived").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert sorted(r.series_uid for r in spark.table("arrived").collect()) == ["1.2", "1.3"]


def test_inventory(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two\nthree")
    (tmp_path / "b.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "c.json").write_text('{"k": 1, "l": [2]}')
    (tmp_path / "d.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">2I", 7, 9))
    head = bytearray(348)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, 4, 5, 6, 1, 1, 1, 1)
    struct.pack_into("<8f", head, 76, 1, 0.5, 0.5, 2.0, 0, 0, 0, 0)
    (tmp_path / "e.nii").write_bytes(bytes(head))
    files = inventory.files(spark, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[1]: r for r in inventory.describe(files).collect()}
    assert (rows["a.txt"].n_lines, rows["a.txt"].n_words) == (2, 3)
    assert rows["b.csv"]["columns"] == ["x", "y"] and rows["b.csv"].n_rows == 2
    assert rows["c.json"].json_keys == ["k", "l"] and rows["d.png"].kind == "image"
    heads = {r.path.rsplit("/", 1)[1]: r for r in inventory.binary_headers(files).collect()}
    assert heads["d.png"].shape == [7, 9] and heads["e.nii"].shape == [4, 5, 6] and heads["e.nii"].spacing == [0.5, 0.5, 2.0] and heads["a.txt"].format is None


def test_sinks(spark, tmp_path):
    series = spark.createDataFrame([("a", "s1", 90.0, [1, 2], True), ("b", "s2", None, None, False)], "study_id string, series_uid string, ml_score double, shape array<int>, tar boolean")
    studies = spark.createDataFrame([("a", 1), ("b", 1)], "study_id string, n long")
    with pytest.raises(ValueError, match="score .1 rows"):
        sinks.checked_parquet(series, f"{tmp_path}/p", "series_uid", {"score": F.col("ml_score") < 50})
    sinks.checked_parquet(series, f"{tmp_path}/p", "series_uid", {"score": F.col("ml_score") <= 100})
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    sinks.csv(series.withColumn("histogram_x", F.lit(1)), f"{tmp_path}/c", ["series_uid"])
    back = spark.read.option("header", True).csv(f"{tmp_path}/c")
    assert back.columns == ["series_uid", "ml_score", "shape", "study_id", "tar"]
    sinks.sqlite(f"{tmp_path}/m.db", {"series": series, "study": studies}, {"series": "study_id", "study": "study_id"}, ("series_study", "series", "study"))
    with sqlite3.connect(f"{tmp_path}/m.db") as db:
        assert db.execute("SELECT series_uid, study_n, shape FROM series_study ORDER BY 1").fetchall() == [("s1", 1, "[1,2]"), ("s2", 1, None)]
    sinks.series_json(series, f"{tmp_path}/j", "study_id")
    assert spark.read.text(f"{tmp_path}/j").count() == 2
    picked, own = sinks.sample_bundle(studies, series, 1, 3)
    assert picked.count() == own.count() == 1
    files = spark.createDataFrame([("a", f"{i}.png", bytes([i]) * 10) for i in range(5)] + [("b", "x", b"y")], "study string, name string, content binary")
    packs = sinks.tar_packs(files, "study", "name", "content", most=25).collect()
    assert sorted((r.study, r.part, r.n) for r in packs) == [("a", 0, 2), ("a", 1, 2), ("a", 2, 1), ("b", 0, 1)]
    assert tarfile.open(fileobj=BytesIO(bytes(packs[0].tar))).getnames()
    assert sinks.json_schema(series.schema)["properties"]["shape"] == {"type": "array", "items": {"type": "integer"}}
    assert "facets" in sinks.datasette_metadata("t", {"series": ["study_id"]}, {"series": "study_id"})


def test_streams_match_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "user_id", "event_type", "value")
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run = windows.tumbling(stream, "ts", "1 day", ["event_type"], "value", None).writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination(120)
    plain = lambda df: sorted((r.start, r.event_type, r.n, round(r.total, 6)) for r in df.collect())
    assert plain(spark.table("tumbled")) == plain(windows.tumbling(events, "ts", "1 day", ["event_type"], "value"))


def test_stage_stream(spark, tmp_path):
    rows = [("x", "in_progress", "2024-01-01 00:00:00"), ("x", "ok", "2024-01-01 01:00:00"), ("y", "failed", "2024-01-01 00:30:00")]
    df = spark.createDataFrame(rows, "stage string, status string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(f"{tmp_path}/in")
    stream = windows.stage_state_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "stage", "status", "at")
    run = stream.writeStream.format("memory").queryName("staged").outputMode("update").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {r.stage: (r.started_at, r.status, r.n_events, r.is_done) for r in spark.table("staged").collect()}
    assert got == {r.stage: (r.started_at, r.status, r.n_events, r.is_done) for r in windows.stage_state(df, "stage", "status", "at").collect()}


def test_files_listed_in_tasks(spark, tmp_path):
    names = ["a.dcm", "s1/b c.dcm", "s1/deep/é.dcm", "s2/x", "s2/_hidden", ".crc/y"]
    for i, n in enumerate(names):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"x" * i)
    (tmp_path / "empty").mkdir()
    got = {r["path"]: r for r in inventory.listed(spark, str(tmp_path)).collect()}
    assert {p: r["length"] for p, r in got.items()} == {f"{tmp_path}/{n}": i for i, n in enumerate(names[:4])}
    seen = inventory.listed(spark, str(tmp_path)).where("length = 0").select(F.unix_seconds("modificationTime").alias("t")).first()["t"]
    assert seen == int((tmp_path / "a.dcm").stat().st_mtime)
