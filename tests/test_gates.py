"""Validators in one report, and writes that are seen only if their gates hold."""

import os

import pytest
from pyspark.sql import functions as F

from radspan.operators import gates
from radspan.sources import sinks


def files(spark):
    rows = [
        ("a", {"PatientComments": "call 123-45-6789"}, None, False),
        ("a", {"(0009,1001)": "x", "(0010,0010)": "y", "(0011,0010)": "z", "SeriesInstanceUID": "123-45-6789"}, None, None),
        ("b", {"PatientComments": "fine"}, None, True),
        ("b", None, "cut off", True),
        ("c", {"PatientComments": None, "PatientID": ""}, None, None),
        (None, {}, None, False),
    ]
    return spark.createDataFrame(rows, "s string, tags map<string,string>, error string, burned boolean")


def test_validators_and_verdicts(spark):
    report = gates.study_validation(files(spark), "s", "tags", "error", "burned", {"ssn": r"\b\d{3}-\d{2}-\d{4}\b"})
    got = {(r.s, r.validator): (r.passed, r.skipped, r.checked, r.dirty, r.found) for r in report.collect()}
    assert len(got) == 16
    assert got["a", "identifiers"] == (False, False, 2, 1, 1) and got["a", "private_tags"] == (False, False, 2, 1, 2)
    assert got["b", "burned_in_text"] == (False, False, 1, 1, 1) and got["b", "readable"] == (False, False, 2, 1, 1)
    assert all(got[s, v][0] for s in ("c", None) for v in gates.VALIDATORS)
    told = {r.s: (r.passed, r.failures) for r in gates.verdicts(report, "s").collect()}
    assert told["a"] == (False, ["identifiers: 1 of 2 files, 1 found", "private_tags: 1 of 2 files, 2 found"])
    assert told["b"] == (False, ["burned_in_text: 1 of 1 files, 1 found", "readable: 1 of 2 files, 1 found"]) and told["c"] == told[None] == (True, [])


def test_skipped_validators_pass_and_say_so(spark):
    report = gates.study_validation(files(spark), "s", "tags", "error", skip=["identifiers", "private_tags", "readable"])
    assert all(r.passed and r.skipped and r.checked == r.dirty == 0 for r in report.collect())
    with pytest.raises(ValueError, match="ocr"):
        gates.study_validation(files(spark), "s", "tags", "error", skip=["ocr"])
    none = gates.study_validation(files(spark).limit(0), "s", "tags", "error")
    assert none.count() == gates.verdicts(none, "s").count() == 0


def test_a_write_is_one_scan_and_seen_only_if_its_gates_hold(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(counted, "id long")
    path = f"{tmp_path}/t"
    told = gates.gated_parquet(df, path, {"ids": F.count_if(F.col("id") < 0), "mean": F.avg("id") > 400})
    assert told == {"rows": 1000, "ids": 0, "mean": True} and read.value == 1000
    for bad in ({"ids": F.count_if(F.col("id") < 7)}, {"mean": F.avg("id") > 500, "fine": F.count("*") > 0}):
        with pytest.raises(ValueError, match=r"not written: (ids \(7 rows\)|mean)$"):
            gates.gated_parquet(df.where("id < 900"), path, bad)
        assert spark.read.parquet(path).count() == 1000 and os.listdir(tmp_path) == ["t"]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        gates.gated_parquet(spark.range(5).selectExpr("1 div (id - 3) as id"), path, {})
    assert spark.read.parquet(path).count() == 1000 and os.listdir(tmp_path) == ["t"]
    gates.gated_parquet(df.where("id < 10").withColumn("p", F.col("id") % 2), path, {}, ["p"])
    assert spark.read.parquet(path).count() == 10 and sorted(n for n in os.listdir(path) if "=" in n) == ["p=0", "p=1"]


def test_an_empty_table_and_null_rules_pass(spark, tmp_path):
    df = spark.createDataFrame([], "id long, v double")
    assert gates.gated_parquet(df, f"{tmp_path}/e", {"mean": F.avg("v") > 1, "n": F.count_if(F.col("v") < 0)})["rows"] == 0
    assert spark.read.parquet(f"{tmp_path}/e").count() == 0
    sinks.checked_parquet(spark.createDataFrame([(1, None)], "id long, v double"), f"{tmp_path}/n", "id", {"v": F.col("v") > 1})
    assert spark.read.parquet(f"{tmp_path}/n").count() == 1
