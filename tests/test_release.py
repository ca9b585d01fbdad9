"""The release flow: outcomes as they were seen, custody, export paths, and runs that take up where others ended."""

import hashlib
import json

from pyspark.sql import functions as F

from radspan.operators import release
from radspan.sources import cache

SCHEMA = "study string, path string, tags map<string,string>, error string, pid string, defaced boolean, burned boolean"
FILES = [
    ("a", "a/1", {"PatientName": "X", "StudyDate": "20240229", "Modality": "MR", "SeriesNumber": "7", "SeriesDescription": "ax / T2  flair!", "InstanceNumber": "12", "(0009,1001)": "x", "ImageComments": "J1234567"}, None, "p", True, False),
    ("a", "a/2", {"SeriesInstanceUID": "1.2", "Remarks": "mail a.b@c.org now", "Null": None}, None, "p", True, None),
    ("b", "b/1", {"Remarks": "fine"}, None, "p", None, False),
    ("b", "b/2", None, "not a file", "p", True, False),
    ("c", "c/1", {"SequenceNotes": "042 555-123-4567"}, None, None, False, True),
    ("d", "d/1", None, None, "p", None, None),
    (None, "n/1", {}, None, None, None, None),
]
HOW = {"path": "path", "tags": "tags", "error": "error", "patient": F.col, "salt": "s", "defaced": "defaced", "burned": "burned"}


def flow(spark, rows=FILES):
    return release.outcomes(spark.createDataFrame(rows, SCHEMA), "study", **(HOW | {"patient": F.col("pid")}))


def test_outcomes_are_what_was_seen(spark):
    got = {r.path: r for r in flow(spark).collect()}
    told = {p: [(s.outcome, s.detail) for s in r.stages] for p, r in got.items()}
    assert told["a/1"] == [("done", None)] * 5 and told["a/2"] == told["a/1"]
    assert told["b/1"] == [("done", None), ("skipped", "no record")] + [("done", None)] * 3
    assert told["b/2"] == [("failed", "not a file")] + [("not_reached", None)] * 4 and told["d/1"][0] == ("failed", "no tags")
    assert told["c/1"][1] == ("failed", None) and told["c/1"][4] == ("failed", "text in the picture")
    assert {p: r.ok for p, r in got.items()} == {"a/1": True, "a/2": True, "b/1": True, "b/2": False, "c/1": False, "d/1": False, "n/1": True}
    tags = got["a/1"].tags
    assert set(tags) == {"PatientName", "StudyDate", "Modality", "SeriesNumber", "SeriesDescription", "InstanceNumber"} and tags["PatientName"] == "" and tags["StudyDate"] < "20240229"
    assert got["a/2"].tags["Remarks"] == "mail now" and got["b/2"].tags is None and got["b/2"].counts is None and got["n/1"].tags == {}
    assert got["a/1"].counts.asDict() == {"tags_removed": 1, "tags_blanked": 1, "uids_replaced": 0, "dates_shifted": 1, "text_scrubbed": 0, "private_stripped": 1}
    text = "\n".join(f"{k}={'null' if v is None else f'{len(v)}:{v}'}" for k, v in sorted(got["a/2"].tags.items()))
    assert got["a/2"].sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_a_failed_study_holds_no_other(spark):
    seen = flow(spark)
    rows = {(r.study, r.stage): (r.done, r.skipped, r.failed, r.not_reached) for r in release.report(seen).collect()}
    assert rows["a", "export"] == (2, 0, 0, 0) and rows["b", "export"] == (0, 0, 0, 2) and rows[None, "export"] == (1, 0, 0, 0)
    assert rows["b", "ingest"] == (1, 0, 1, 0) and rows["b", "deface"] == (0, 1, 0, 1) and len(rows) == 30
    assert {r.study: (r.files, r.reasons) for r in release.held(seen).collect()} == {"b": (1, ["ingest: not a file"]), "c": (1, ["deface", "validate: text in the picture"]), "d": (1, ["ingest: no tags"])}
    assert {r.path for r in release.exports(seen).collect()} == {"a/1", "a/2", "n/1"}
    empty = flow(spark, [])
    assert release.report(empty).count() == 0 and release.custody_documents(empty).count() == 0 and release.exports(empty).count() == 0


def test_custody_documents_in_parts(spark):
    seen = flow(spark, [("s", f"s/{i}", {"K": str(i)}, None, "p", i % 2 == 0 or None, None) for i in range(50)] + FILES[:2])
    docs = {(r.study, r.part): json.loads(r.document) for r in release.custody_documents(seen, 20).collect()}
    assert docs["s", 0]["parts"] == 3 and docs["s", 0]["output_file_count"] == 50 and docs["s", 0]["defacing_applied"] is False and docs["a", 0]["defacing_applied"] is True
    assert docs["a", 0]["tags_removed"] == 1 and docs["a", 0]["source_archive_id"] == hashlib.sha256(b"a").hexdigest()[:16]
    sums = {c["path"]: c["sha256"] for (s, p), d in docs.items() if s == "s" and p > 0 for c in d["checksums"]}
    assert sums == {f"s/{i}": hashlib.sha256(f"K={len(str(i))}:{i}".encode()).hexdigest() for i in range(50)}
    xor = 0
    for path, s in sums.items():
        xor ^= int(hashlib.sha256(f"{path} {s}".encode()).hexdigest()[:15], 16)
    assert int(docs["s", 0]["fingerprint"], 16) == xor


def test_clean_path(spark):
    tags = [{"StudyDate": "20240101", "Modality": "MR", "SeriesNumber": "7", "SeriesDescription": " ax / T2  fläir!", "InstanceNumber": "12"}, {}, {"SeriesNumber": "12345", "SeriesDescription": "x" * 60, "InstanceNumber": "1234567", "StudyDate": "../..", "Modality": "a/b"}, {"StudyDate": "///", "Modality": "?"}]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, t map<string,string>").orderBy("i").select(release.clean_path(F.col("t"))).collect()]
    assert got == ["20240101_MR/0007__ax_T2_fläir/000012.dcm", "unknown_unknown/0000_unknown/000000.dcm", f"....._ab/12345_{'x' * 44}/1234567.dcm".replace(".....", "...."), "unknown/0000_unknown/000000.dcm"]


def test_a_run_takes_up_what_changed(spark, tmp_path):
    root, read = f"{tmp_path}/r", spark.sparkContext.accumulator(0)
    at = F.to_timestamp(F.lit("2024-01-01")).alias("modificationTime")
    listed = lambda rows: spark.createDataFrame([(s, p, 1) for s, p, *_ in rows], "study string, path string, length long").select("study", "path", "length", at)

    def reader(rows):
        def counted(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        return lambda files: files.select("study", "path").mapInArrow(counted, "study string, path string").join(spark.createDataFrame(rows, SCHEMA), ["study", "path"])

    def told(rows):
        read.value = 0
        states = {r.study: r.state for r in release.run(listed(rows), root, "study", reader(rows), **(HOW | {"patient": F.col("pid")})).collect()}
        return states, {r.path: r.ok for r in cache.cached(spark, root, "study").collect()}, read.value

    rows = [r for r in FILES if r[0]]
    states, ok, n = told(rows)
    assert set(states.values()) == {"new"} and n >= 6 and ok == {"a/1": True, "a/2": True, "b/1": True, "b/2": False, "c/1": False, "d/1": False}
    mended = [r for r in rows if r[1] != "b/2"]
    states, ok, n = told(mended)
    assert states == {"a": "same", "b": "changed", "c": "same", "d": "same"} and n == 1 and ok["b/1"] and "b/2" not in ok
    assert {r.study for r in release.report(cache.cached(spark, root, "study")).where("released").collect()} == {"a", "b"}
