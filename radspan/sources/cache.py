"""What was extracted from files, kept by the fingerprints (path, length, time) of a study's files: only studies that changed
are read again.

A cache is a folder: `rows/` in parts by study, and `fingerprints/`, one row for each file, which is replaced whole after
the rows are written. A run that dies before that leaves fingerprints that do not agree with what is listed, so the next
run extracts those studies again; a study counts only while it has fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.operators.gates import _there, gated_parquet
from radspan.sources.scratch import work_table

PRINT = ["path", "length", "modificationTime"]


def changes(listed: DataFrame, known: DataFrame, study: str) -> DataFrame:
    """study, state (`new`, `changed`, `same`, `gone`) by the fingerprints of its files; both have a row for each file.

    A file that came, went, or has another length or time changes its study. Rows that repeat count once; files without a
    study or path count for nothing.
    """
    prints = lambda df, n: df.select(F.col(study).alias("study"), *PRINT).where("study IS NOT NULL AND path IS NOT NULL").distinct().withColumn("_new", F.lit(n)).withColumn("_old", F.lit(1 - n))
    both = prints(listed, 1).unionByName(prints(known, 0)).groupBy("study", *PRINT).agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"))
    per = both.groupBy("study").agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"), F.count_if(F.col("_new") != F.col("_old")).alias("_odd"))
    state = F.when(F.col("_old") == 0, "new").when(F.col("_new") == 0, "gone").when(F.col("_odd") > 0, "changed").otherwise("same")
    return per.select(F.col("study").alias(study), state.alias("state"))


def refresh(listed: DataFrame, root: str, study: str, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """study, state of each study, after the cache at `root` has been brought up to what is listed (study, path, length, modificationTime).

    extract gets the listed files of new and changed studies and returns rows with the study's column; a file that cannot
    be read should become a row with an error, as a failure ends the run and leaves the cache as it was. Studies of which
    nothing changed are not read. A study for which extract has no rows is known all the same, and has none.
    """
    spark = listed.sparkSession
    listed = work_table(listed.select(F.col(study).cast("string").alias(study), *PRINT).where(F.col(study).isNotNull() & F.col("path").isNotNull()).distinct(), "listed")
    prints = f"{root}/fingerprints"
    known = spark.read.schema(listed.schema).parquet(prints) if _there(spark, prints) else listed.limit(0)
    states = work_table(changes(listed, known, study), "states")
    stale = states.where("state IN ('new', 'changed')").select(study)
    if not stale.isEmpty():
        rows = extract(listed.join(stale, study, "left_semi")).withColumn("_kept", F.lit(True))
        # a row that marks the study replaces what is left of an older one where extract has none
        marks = stale.withColumn("_kept", F.lit(False))
        whole = rows.unionByName(marks, allowMissingColumns=True).repartition(study)
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(study).parquet(f"{root}/rows")
    gated_parquet(listed, prints, {})
    return states


def cached(spark: SparkSession, root: str, study: str) -> DataFrame:
    """The rows of all studies that the cache knows; their columns are those of the newest extraction and older ones."""
    known = spark.read.parquet(f"{root}/fingerprints").select(study).distinct()
    if not _there(spark, f"{root}/rows"):
        return known.limit(0)
    rows = spark.read.option("mergeSchema", True).parquet(f"{root}/rows").where("_kept").drop("_kept").withColumn(study, F.col(study).cast("string"))
    return rows.join(known, study, "left_semi")
