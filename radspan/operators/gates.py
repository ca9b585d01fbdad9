"""Gates: the validators of a study in one report, and writes that become visible only if what they hold passes.

Both look at their table once. The validators are counts of one grouped aggregate; a gate of a write is observed while
the rows are written, to a folder beside the target that takes its place only after all gates hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from radspan.operators import privacy

VALIDATORS = ("identifiers", "private_tags", "burned_in_text", "readable")


def study_validation(df: DataFrame, study: str, tags: str, error: str, burned: str | None = None, patterns: dict[str, str] = privacy.SCAN, ignored: list[str] = privacy.SKIPPED, skip: Iterable[str] = ()) -> DataFrame:
    """study, validator, passed, skipped, checked, dirty, found: a row for each study and validator; df has one row per file.

    dirty: files that break it; found: matches, private tags, or the dirty files again. A file with an error fails
    `readable` and is not checked by the others. burned: a column that tells files with text in the picture (null: none);
    without it, and for those in `skip`, the validator is skipped and passes. Files without a study form a group of their own.
    """
    unknown = set(skip) - set(VALIDATORS)
    if unknown:
        raise ValueError(f"no validators: {sorted(unknown)}")
    skipped = {*skip, *(() if burned else ("burned_in_text",))}
    whole = F.col(error).isNull()
    values = F.map_values(F.map_filter(tags, lambda k, v: ~k.isin(ignored or [""]) & (F.length(v) >= 3)))
    matches = F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + privacy.match_count(v, patterns))
    odd = F.size(F.filter(F.map_keys(tags), lambda t: F.coalesce(privacy._private(t), F.lit(False)))).cast("long")
    counts = {
        "identifiers": F.lit(0) if "identifiers" in skipped else matches,
        "private_tags": F.lit(0) if "private_tags" in skipped else odd,
        "burned_in_text": F.lit(0) if burned is None else F.col(burned).cast("long"),
    }
    rows = df.select(F.col(study).alias("study"), whole.alias("_whole"), *[F.when(whole, F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(f"_{n}") for n, c in counts.items()])
    sums = [agg for n in counts for agg in (F.count_if(F.col(f"_{n}") > 0).alias(f"{n}_dirty"), F.sum(f"_{n}").alias(f"{n}_found"))]
    per = rows.groupBy("study").agg(F.count("*").alias("_files"), F.count_if("_whole").alias("_read"), *sums)
    bad = F.col("_files") - F.col("_read")

    def told(name: str) -> Column:
        dirty, found = (bad, bad) if name == "readable" else (F.col(f"{name}_dirty"), F.col(f"{name}_found"))
        if name in skipped:
            passed, checked, dirty, found = F.lit(True), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")
        else:
            passed, checked = dirty == 0, F.col("_files" if name == "readable" else "_read")
        return F.struct(F.lit(name).alias("validator"), passed.alias("passed"), F.lit(name in skipped).alias("skipped"), checked.alias("checked"), dirty.alias("dirty"), found.alias("found"))

    return per.select("study", F.inline(F.array(*map(told, VALIDATORS)))).withColumnRenamed("study", study)


def verdicts(report: DataFrame, study: str) -> DataFrame:
    """study, passed, failures: whether every validator passes, and a line for each that does not, in their order."""
    place = F.array_position(F.array(*map(F.lit, VALIDATORS)), F.col("validator"))
    line = F.concat("validator", F.lit(": "), F.col("dirty").cast("string"), F.lit(" of "), F.col("checked").cast("string"), F.lit(" files, "), F.col("found").cast("string"), F.lit(" found"))
    failed = F.sort_array(F.collect_list(F.when(~F.col("passed"), F.struct(place.alias("place"), line.alias("line")))))
    return report.groupBy(study).agg(F.bool_and("passed").alias("passed"), F.transform(failed, lambda f: f["line"]).alias("failures"))


def _moved(spark: SparkSession, source: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not path(source).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(source), path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def _there(spark: SparkSession, at: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _removed(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _failure(name: str, value: object) -> str | None:
    if isinstance(value, bool) or value is None:
        return name if value is False else None
    n, *first = value if isinstance(value, Row) else (value,)
    return f"{name} ({n} rows{', first ' + str(first[0]) if first else ''})" if n else None


def gated_parquet(df: DataFrame, path: str, gates: dict[str, Column], partition_by: Iterable[str] = ()) -> dict[str, object]:
    """Writes df in the pass that judges it; the gates' values, or ValueError that names those that fail, and nothing is changed.

    gates: aggregates over all rows, each true to pass (null, as of an empty table, passes) or a count of rows that must
    be 0, or a struct of such a count and the first of those rows. What is at `path` is replaced only after the rows are written and judged; an interrupted write leaves it as it
    was, with a folder `<path>.new-<id>` beside it. Where a store has no rename of its own, that step copies.
    """
    spark, mark, names = df.sparkSession, uuid.uuid4().hex, list(gates)
    fresh, old, seen = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}", Observation(f"gates-{mark}")
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[gates[n].alias(f"gate{i}") for i, n in enumerate(names)])
    try:
        rows.write.partitionBy(*partition_by).option("compression", "snappy").parquet(fresh)
        found = {n: seen.get[f"gate{i}"] for i, n in enumerate(names)}
        failed = [line for n, v in found.items() if (line := _failure(n, v))]
        if failed:
            raise ValueError("not written: " + ", ".join(sorted(failed)))
    except BaseException:
        _removed(spark, fresh)
        raise
    if _there(spark, path):
        _moved(spark, path, old)
    try:
        _moved(spark, fresh, path)
    except BaseException:
        if _there(spark, old):
            _moved(spark, old, path)
        raise
    _removed(spark, old)
    return {"rows": seen.get["rows"], **found}
