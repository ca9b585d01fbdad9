"""The header source over more files than the driver holds: planned by folders, which tasks list."""

import pickle
import tracemalloc

import pytest
from pyarrow import fs
from pyspark.sql.datasource import EqualTo, GreaterThan, StringContains, StringStartsWith
from pyspark.sql.types import StructType

from radspan.sources import dicom_files, dicom_source

PLAIN = [("PatientID", "P1"), ("Rows", "256"), ("InstanceNumber", "7")]


def _reader(root, ddl="path string, length long, tags map<string,string>, error string", **options):
    return dicom_source.HeaderReader({"path": str(root), **options}, StructType.fromDDL(ddl))


def _read(reader, parts):
    return sorted(r["path"] for p in parts for b in reader.read(pickle.loads(pickle.dumps(p))) for r in b.to_pylist())


def test_the_driver_keeps_no_names_of_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dicom_source, "LISTED", 100, raising=False)
    (tmp_path / "s").mkdir()
    for i in range(20_000):
        (tmp_path / f"s/f{i}.dcm").touch()
    reader = _reader(tmp_path)
    tracemalloc.start()
    parts = reader.partitions()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500_000 and len(pickle.dumps(parts)) < 20_000
    assert len(parts) == dicom_source.SHARERS  # of one folder, each a like part of its names
    shares = [list(reader._paths(p)) for p in parts]
    assert sorted(p for s in shares for p in s) == sorted(f"file://{tmp_path}/s/f{i}.dcm" for i in range(20_000))
    assert max(map(len, shares)) < 1.3 * 20_000 / dicom_source.SHARERS


def test_plans_by_folders_and_by_files_read_the_same(spark, tmp_path, monkeypatch):
    for i in range(30):
        (tmp_path / f"s{i % 7}/deep{i % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"s{i % 7}/f{i}.dcm").write_bytes(dicom_files.encoded(PLAIN, pixels=100 * i))
        (tmp_path / f"s{i % 7}/deep{i % 3}/ü{i}").write_bytes(dicom_files.encoded(PLAIN) if i % 2 else b"another kind")
    (tmp_path / "s1/folder.dcm").mkdir()
    (tmp_path / "s1/folder.dcm/_f.IMA").write_bytes(b"short")
    (tmp_path / "s1/notes.txt").write_text("no")
    (tmp_path / "linked").symlink_to(tmp_path / "s2")
    (tmp_path / "s3/lost.dcm").symlink_to(tmp_path / "nowhere")
    (tmp_path / "empty").mkdir()
    filters = [[], [StringContains(("path",), "/deep1/")], [GreaterThan(("length",), 1500), StringStartsWith(("path",), f"file://{tmp_path}/s")], [EqualTo(("path",), "none")]]
    for tests in filters:
        for options in ({}, {"pathglobfilter": "f1*"}, {"partitionbytes": 1}, {"path": f"file:{tmp_path}/"}):
            reader = _reader(tmp_path, **options)
            assert list(reader.pushFilters(tests)) == []
            by_files = reader.partitions()
            assert all(isinstance(p, dicom_source.FilesOf) for p in by_files)
            want = _read(reader, by_files)
            with monkeypatch.context() as m:
                m.setattr(dicom_source, "LISTED", 0)
                by_folders = reader.partitions()
            assert _read(reader, by_folders) == want
            assert all(isinstance(p, dicom_source.FoldersOf) for p in by_folders) or not want
    reader = _reader(tmp_path)
    assert len(_read(reader, reader.partitions())) == 30 + 15 + 1 + 6  # files of other kinds and lost links do not count, linked folders do
    with pytest.raises(FileNotFoundError):
        _reader(tmp_path / "nowhere").partitions()


def test_folders_are_dealt_by_the_files_they_hold(spark, monkeypatch):
    counted = [(f"/s{i}", 1 + i % 3) for i in range(50_000)] + [("/large", 1_000_000)] + [(f"/t{i}", 300) for i in range(3_000)]
    parts = _reader("/x")._dealt(iter(counted))
    whole = [p for p in parts if p.shares == 1]
    assert sorted(f for p in whole for f in p.folders) == sorted(f for f, _ in counted if f != "/large")
    assert [(list(p.folders), p.share) for p in parts if p.shares > 1] == [(["/large"], i) for i in range(dicom_source.SHARERS)]
    files, most = dict(counted), sum(n for _, n in counted) // dicom_source.PARTITIONS
    assert max(sum(files[f] for f in p.folders) for p in whole) <= most
    assert len(parts) <= 2 * dicom_source.PARTITIONS
    asked = _reader("/x", partitionbytes=4 * (dicom_source.OPEN_COST + dicom_source.HEADER_BYTES))._dealt(iter(counted[:100]))
    assert max(sum(files[f] for f in p.folders) for p in asked) <= 4


def test_folders_of_another_store(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / f"b/s{i % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"b/s{i % 3}/f{i}.dcm").write_bytes(dicom_files.encoded(PLAIN))
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(dicom_source.Files, "at", lambda self, path: (store, path.split("://", 1)[1]))
    reader = _reader("mem://b")
    want = _read(reader, reader.partitions())
    monkeypatch.setattr(dicom_source, "LISTED", 0)
    monkeypatch.setattr(dicom_source, "PARTITION_BYTES", 1)
    assert _read(reader, parts := reader.partitions()) == want == sorted(f"mem://b/s{i % 3}/f{i}.dcm" for i in range(40))
    assert len(parts) > 3
