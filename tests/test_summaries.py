"""Summaries on hand-made rows: empty tables, nulls, ties, literal values."""

import pytest
from pyspark.sql import functions as F

from radspan.functions import exports
from radspan.operators import summaries


def test_subject_numbers(spark):
    names = [(n,) for n in ["b", "a", None, "a", "", "é", "B"]] + [(f"s{i:05d}",) for i in range(1200)]
    got = {r["name"]: r["subject"] for r in summaries.subject_numbers(spark.createDataFrame(names, "name string").repartition(3), "name").collect()}
    order = sorted({n for (n,) in names if n is not None}, key=lambda n: n.encode())
    assert got == {n: f"{i:03d}" for i, n in enumerate(order, 1)}
    assert summaries.subject_numbers(spark.createDataFrame([], "name string"), "name").collect() == []


def test_subject_numbers_join_no_plan_to_itself(spark, tmp_path):
    spark.range(500).select(F.format_string("s%05d", "id").alias("name")).write.parquet(str(tmp_path / "names"))
    got = summaries.subject_numbers(spark.read.parquet(str(tmp_path / "names")), "name")
    assert got.count() == 500 and all("radspan-" in f for f in got.inputFiles())


def test_annotation_summary(spark):
    rows = [(1, "B", ["x", None]), (1, "A", ["y", "x"]), (None, "C", None), (2, None, [])]
    df = spark.createDataFrame(rows, "k int, grade string, tags array<string>")
    got = {r["k"]: r for r in summaries.annotation_summary(df, "k", {"grade": F.col("grade")}, {"tags": F.col("tags")}, {"a": F.col("grade") == "A"}).collect()}
    assert got[1]["grade_mode"] == "A" and got[1]["tags"] == ["x", "y"] and got[1]["a"] == 1 and got[1]["n"] == 2
    assert got[None]["grade_mode"] == "C" and got[None]["tags"] == [] and got[2]["grade_mode"] is None and got[2]["n"] == 1


def test_strict_map_fails_on_unmapped(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="no value for 2"):
        summaries.mapped_strict(df, spark.createDataFrame([(1, "a")], "k int, v string"), "k", "v").collect()
    both = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    assert {tuple(r) for r in summaries.mapped_strict(df, both, "k", "v").collect()} == {(1, None), (2, "b")}


def test_empty_totals(spark):
    files = spark.createDataFrame([], "completeness_pct double")
    assert summaries.conformance_totals(files, files).first()["pass_rate"] == 100.0


def test_small_rules(spark):
    paths = [("anat/sub-001_T1w.nii.gz",), ("./a b/x.nii",), ("q.DCM",), ("none",)]
    form, media = exports.media_type(F.col("p"))
    got = [tuple(r) for r in spark.createDataFrame(paths, "p string").select(exports.group_name(F.col("p")), form, media).collect()]
    assert got == [("anat/sub-001_T1w", None, None), ("a_b/x", None, None), ("q.DCM", "dcm", "application/dicom"), ("none", None, None)]
