"""Extraction kept by fingerprints: unchanged studies are not read again, a run that dies is made up for."""

import pytest
from pyspark.sql import functions as F

from radspan.sources import cache


def listing(spark, files):
    return spark.createDataFrame([(s, p, n, None) for s, p, n in files], "study string, path string, length long, t string").select("study", "path", "length", F.to_timestamp(F.lit("2024-01-01")).alias("modificationTime"))


def test_only_changed_studies_are_read_again(spark, tmp_path):
    root, read = f"{tmp_path}/c", spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def extract(run):
        return lambda files: files.select("study", "path", "length").mapInArrow(counted, "study string, path string, length long").where("length > 0").withColumn("run", F.lit(run))

    def told(files, run):
        read.value = 0
        states = {r.study: r.state for r in cache.refresh(listing(spark, files), root, "study", extract(run)).collect()}
        return states, sorted((r.study, r.path, r.length, r.run) for r in cache.cached(spark, root, "study").collect()), read.value

    files = [("a", "a/1", 1), ("a", "a/2", 2), ("b", "b/1", 1), ("c", "c/1", 1), ("d=/ é", "d/1", 1), ("e", "e/1", 0), (None, "x", 1), ("a", None, 1), ("a", "a/1", 1)]
    new = {s: "new" for s in ("a", "b", "c", "d=/ é", "e")}
    states, rows, n = told(files, 1)
    assert states == new and n == 6 and rows == sorted((s, p, k, 1) for s, p, k in set(files) if s and p and k)
    states, same, n = told(files, 2)
    assert set(states.values()) == {"same"} and same == rows and n == 0
    # a grows, b has another length, c goes, a file of none left is still known
    later = [("a", "a/1", 1), ("a", "a/2", 2), ("a", "a/3", 3), ("b", "b/1", 9), ("d=/ é", "d/1", 1), ("e", "e/1", 0)]
    states, rows, n = told(later, 3)
    assert states == {"a": "changed", "b": "changed", "c": "gone", "d=/ é": "same", "e": "same"} and n == 4
    assert rows == [("a", "a/1", 1, 3), ("a", "a/2", 2, 3), ("a", "a/3", 3, 3), ("b", "b/1", 9, 3), ("d=/ é", "d/1", 1, 1)]
    states, rows, n = told([("a", "a/1", 0)], 4)  # a has no rows left
    assert states["a"] == "changed" and rows == [] and n == 1


def test_a_run_that_dies_leaves_the_cache_and_is_made_up_for(spark, tmp_path):
    root, files = f"{tmp_path}/c", [("a", "a/1", 1), ("b", "b/1", 1)]
    keep = lambda files: files.select("study", "path", "length")
    cache.refresh(listing(spark, files), root, "study", keep)
    more = listing(spark, [*files, ("b", "b/2", 0)])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        cache.refresh(more, root, "study", lambda f: f.select("study", "path", F.expr("1 div length").alias("length")))
    assert sorted(r.path for r in cache.cached(spark, root, "study").collect()) == ["a/1", "b/1"]
    assert {r.study: r.state for r in cache.refresh(more, root, "study", keep).collect()} == {"a": "same", "b": "changed"}
    assert cache.cached(spark, root, "study").count() == 3


def test_nothing_listed(spark, tmp_path):
    assert cache.refresh(listing(spark, []), f"{tmp_path}/c", "study", lambda f: f).count() == 0
    assert cache.cached(spark, f"{tmp_path}/c", "study").count() == 0
