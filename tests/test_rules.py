"""Rules with expected values written out: scans of tags, advice, dataset descriptions, annotation summaries, small filters."""

import json

import pytest
from pyspark.sql import functions as F

from radspan.operators import cohorts, consensus, integrity, manifest, privacy
from radspan.sources import inventory


def test_scan_tags(spark):
    rows = [
        (1, {"PatientComments": "call 123-456-7890, ssn 123-45-6789", "SeriesInstanceUID": "123-45-6789"}, None),
        (2, {"PatientName": "x", "Manufacturer": "www.maker.com"}, None),
        (3, {"PatientComments": "123-45-6789"}, "cut short"),
        (4, None, None),
        (5, {"PatientComments": None}, None),
    ]
    df = spark.createDataFrame(rows, "k int, tags map<string,string>, error string")
    got = privacy.scan_tags(df.where("k < 3"), "k", "tags").collect()
    assert sorted((r.k, r.tag, r.pattern, r.match) for r in got) == [(1, "PatientComments", "phone_us", "123-456-7890"), (1, "PatientComments", "ssn", "123-45-6789")]
    assert privacy.scan_totals(df, "k", "tags", "error").first() == (5, 3, 1, 1, 2, False)
    assert privacy.scan_totals(df.limit(0), "k", "tags", "error").first() == (0, 0, 0, 0, 0, True)
    assert len(privacy.SKIPPED) == len(set(privacy.SKIPPED)) == 48


def test_recommendations(spark):
    tags = {"PatientName": "a", "InstitutionName": "b", "PatientID": "7", "StudyDate": "20200101", "DeviceSerialNumber": "9", "StudyInstanceUID": "1.2"}
    df = spark.createDataFrame([(1, tags), (2, {"PatientName": ""})], "k int, tags map<string,string>")
    got = [r.advice.split(":")[0] for r in privacy.recommendations(privacy.inventory(df, "k", "tags"), "k").orderBy("place").collect()]
    assert got == ["Names of patients or physicians occur", "Patient ids may derive from a national number", "Dates of birth or service occur", "Institutions, addresses or stations occur", "Instance ids occur and can be linked", "Serial numbers of devices occur", "1 files hold three or more sensitive categories"]
    clean = privacy.recommendations(privacy.inventory(df.where("k = 2"), "k", "tags"), "k").collect()
    assert [r.advice for r in clean] == [privacy.LITTLE_FOUND]


def test_dataset_description(spark):
    file = {"@id": "f", "@type": "cr:FileObject", "name": "n", "contentUrl": "u"}
    record = {"@id": "r", "@type": "cr:RecordSet", "name": "n", "field": [{"@id": "x"}]}
    good = {"@context": {"a": 1}, "@type": "sc:Dataset", "name": "n", "sc:description": "d", "url": "u", "license": "l", "distribution": [file], "recordSet": [record]}
    cases = [
        (good, []),
        ({k: v for k, v in good.items() if k != "@context"}, ["lacks @context"]),
        (good | {"@type": "x"}, ["is no dataset"]),
        ({k: v for k, v in good.items() if k != "sc:description"}, ["lacks description or sc:description"]),
        (good | {"distribution": []}, ["lacks a list distribution"]),
        (good | {"distribution": [file, {"@id": "g", "@type": "t", "name": "n"}]}, ["distribution[1]: lacks contentUrl or sc:contentUrl or cr:FileObject or cr:FileSet or cr:source or source"]),
        (good | {"recordSet": [record | {"@type": "y", "field": []}]}, ["recordSet[0]: is no cr:RecordSet", "recordSet[0]: lacks fields"]),
    ]
    rows = [(i, json.dumps(d)) for i, (d, _) in enumerate(cases)] + [(97, "[1]"), (98, "no"), (99, None)]
    df = spark.createDataFrame(rows, "k int, raw string").withColumn("errors", integrity.dataset_description_errors(F.col("raw")))
    got = {r.k: r.errors for r in df.collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
    assert got[97] == got[98] == got[99] == ["is no JSON object"]


def test_annotation_summary(spark):
    one, same, two = ("left", "high", 3), ("left", "high", 3), (None, None, None)
    rows = [("a", 1, True, [], [one, two]), ("a", 2, True, ["grade"], [same]), ("a", 3, None, None, None), ("b", 1, False, [None], [])]
    rows += [("c", i, True, [], [("spot", "low", i)]) for i in range(25)]
    df = spark.createDataFrame(rows, "s string, n int, found boolean, quarrels array<string>, findings array<struct<location:string,signal_on_this_sequence:string,size_mm:int>>")
    got = {r.s: tuple(r)[1:] for r in consensus.annotation_summary(df, "s", "n", "found", "quarrels", "findings").collect()}
    assert got["a"] == (3, 2, 1, True, ["left|high|3", "?||"]) and got["b"] == (1, 0, 0, False, [])
    assert got["c"][4] == [f"spot|low|{i}" for i in range(20)]


def test_checksums_skip_and_missing(spark):
    df = spark.createDataFrame([("a.txt", "x"), ("b.tmp", "y"), ("c.txt", "z")], "path string, content string")
    was = integrity.checksums(df, "path", "content", r"\.tmp$")
    assert {r.path for r in was.collect()} == {"a.txt", "c.txt"}
    now = integrity.checksums(df.where("path <> 'c.txt'").withColumn("content", F.lit("w")), "path", "content")
    assert {tuple(r) for r in integrity.verify(was, now, "path").collect()} == {("a.txt", "mismatch"), ("c.txt", "missing")}


def test_small_rules(spark):
    df = spark.createDataFrame([("x", ["1"] * 5), (None, ["1"]), (None, None), (None, ["1"] * 3)], "done string, files array<string>")
    assert [r.w for r in df.select(cohorts.quality_skip(F.col("done"), F.col("files")).alias("w")).collect()] == ["done", "too_few_files (1)", "too_few_files (0)", None]
    paths = spark.createDataFrame([("a/.x/b",), ("a/_internal/b",), (".h",), ("a/b.txt",), ("a/my_internal/b",), ("a/./b",)], "p string")
    assert [r.h for r in paths.select(inventory.hidden(F.col("p")).alias("h")).collect()] == [True, True, True, False, False, False]
    assert [r.h for r in paths.select(inventory.matches_any(F.col("p"), ["*.txt", ".?"]).alias("h")).collect()] == [False, False, True, True, False, False]
    assert not paths.select(inventory.matches_any(F.col("p"), []).alias("h")).first().h
    named = spark.createDataFrame([("a",), (None,)], "v string")
    assert [r.v for r in manifest.replaced_strict(named, "v", {"a": "A"}).collect()] == ["A", None]
    with pytest.raises(Exception, match="no name for b"):
        manifest.replaced_strict(spark.createDataFrame([("b",)], "v string"), "v", {"a": "A"}).collect()
