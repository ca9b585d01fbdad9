"""Totals and rules around a run: subject numbers, annotation summaries, counters of changes, custody, follow-up reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.functions import text
from radspan.sources.scratch import work_table


def subject_numbers(df: DataFrame, name: str) -> DataFrame:
    """name, subject: each distinct name's place in the order of names as three digits or more (001, 002, ...).

    256 names, those of the smallest hash for each of its first two digits, cut the order into runs. Runs are counted,
    added up over the runs before them and numbered on their own, so no task sorts all names. Null names are left out.
    Names and runs are joined as work tables: a plan that joined the names to counts of themselves lost a column when large.
    """
    names = df.where(F.col(name).isNotNull()).select(name).distinct()
    digest = F.sha2(F.col(name).cast("string"), 256)
    cuts = [r[0] for r in names.groupBy(F.substring(digest, 1, 2)).agg(F.min_by(name, digest).alias("cut")).select("cut").collect()]  # at most 256
    run = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(name))) if cuts else F.lit(0)
    rows = work_table(names.withColumn("_run", run), "names")
    runs = rows.groupBy("_run").agg(F.count("*").alias("_n"))  # at most 257 rows
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = work_table(runs.select("_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "runs")
    own = F.row_number().over(Window.partitionBy("_run").orderBy(name))
    return rows.join(F.broadcast(runs), "_run").select(name, F.format_string("%03d", own + F.col("_before")).alias("subject"))


def annotation_summary(df: DataFrame, key: str, values: dict[str, Column], tags: dict[str, Column], flags: dict[str, Column]) -> DataFrame:
    """One row per key: for each value its counts (`<name>_counts`, in order) and the most frequent one (`<name>_mode`, of
    ties the first), for each tag array the distinct tags in order, for each flag the number of true rows.

    Null values and tags are left out. Values are counted before they are gathered, so a list grows with the distinct
    values of a key, not with its rows.
    """
    kinds = [F.array(F.struct(F.lit(n).alias("kind"), c.cast("string").alias("value"))) for n, c in values.items()]
    kinds += [F.transform(c, _tagged(n)) for n, c in tags.items()]
    none = F.array().cast("array<struct<kind:string,value:string>>")
    pairs = df.select(key, F.explode(F.concat(*[F.coalesce(k, none) for k in kinds])).alias("p")).where(F.col("p.value").isNotNull())
    counts = pairs.groupBy(key, "p.kind", "p.value").agg(F.count("*").alias("n"))
    of = lambda n, what: F.when(F.col("kind") == n, what)
    wide = [F.sort_array(F.collect_list(of(n, F.struct("value", "n")))).alias(f"{n}_counts") for n in values]
    wide += [F.min(of(n, F.struct((-F.col("n")).alias("m"), "value")))["value"].alias(f"{n}_mode") for n in values]
    wide += [F.sort_array(F.collect_list(of(n, F.col("value")))).alias(n) for n in tags]
    totals = df.groupBy(key).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    found = counts.groupBy(F.col(key).alias("_of")).agg(*wide)
    return totals.join(found, totals[key].eqNullSafe(found["_of"]), "left").drop("_of")


def _tagged(kind: str):
    return lambda v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value"))


def batch_totals(studies: DataFrame, annotations: DataFrame, files: str, slices: str, gigabytes: str, error: str, finding: Column) -> DataFrame:
    """One row: studies, files, slices and their size, studies with an error, series annotated and those with a finding."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    run = studies.agg(F.count("*").alias("total_studies"), total(files).alias("total_files"), total(slices).alias("total_slices"), total(gigabytes).alias("total_gb"), F.count(error).alias("n_errors"))
    seen = annotations.agg(F.count("*").alias("series_annotated"), F.count_if(F.coalesce(finding, F.lit(False))).alias("finding_detected"))
    return run.join(F.broadcast(seen))  # one row each


def conformance_totals(files: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: files, files with issues, the share without any in percent (100 without files), and the issues' completeness."""
    bad = issues.agg(F.count("*").alias("files_with_issues"), F.avg("completeness_pct").alias("avg_pct"), F.min("completeness_pct").alias("min_pct"), F.max("completeness_pct").alias("max_pct"))
    both = files.agg(F.count("*").alias("total_files")).join(F.broadcast(bad))  # one row each
    return both.withColumn("pass_rate", F.round(100 * (1 - F.col("files_with_issues") / F.greatest("total_files", F.lit(1))), 1))


def change_counts(before: Column, after: Column, remove: list[str], blank: list[str], uids: list[str], dates: list[str], private: Column) -> dict[str, Column]:
    """How many tags of a map a cleaning removed, blanked, replaced, shifted, scrubbed, or stripped as private (`private`: an
    array of those). A tag counts where it was there before, even with a null value, and its value is another one, or gone, after."""
    held = lambda names: F.map_filter(before, lambda k, v: k.isin(names or [""]))
    now = lambda k: F.try_element_at(after, k)
    changed = lambda names: F.size(F.map_filter(held(names), lambda k, v: ~v.eqNullSafe(now(k)))).cast("long")
    listed = [*remove, *blank, *uids, *dates]
    other = F.map_filter(before, lambda k, v: ~k.isin(listed or [""]) & F.map_contains_key(after, k) & ~v.eqNullSafe(now(k)))
    return {
        "tags_removed": F.size(held(remove)).cast("long"),
        "tags_blanked": changed(blank),
        "uids_replaced": changed(uids),
        "dates_shifted": changed(dates),
        "text_scrubbed": F.size(other).cast("long"),
        "private_stripped": F.size(private).cast("long"),
    }


def custody(files: DataFrame, study: str, source: Column, passed: Column, defaced: Column) -> DataFrame:
    """One row per study: files written, a one-way id of where they came from, whether all were defaced and valid.

    The id hashes the source alone, without the time, so a second run gives the same; what was done is recorded per file
    and never assumed. Checksums stay rows (`integrity.checksums`), as a study may hold any number of files.
    """
    all_of = lambda c: F.bool_and(F.coalesce(c, F.lit(False)))
    return files.groupBy(study).agg(F.count("*").alias("output_file_count"), F.substring(F.sha2(F.min(source), 256), 1, 16).alias("source_archive_id"), all_of(defaced).alias("defacing_applied"), all_of(passed).alias("validation_passed"))


def mapped_strict(df: DataFrame, mapping: DataFrame, key: str, name: str) -> DataFrame:
    """df with column `name` from the mapping (key, name; one row a key); a key without a row there is an error."""
    to = mapping.select(F.col(key).alias("_of"), F.col(name).alias("_to"), F.lit(True).alias("_there"))
    found = df.join(to, df[key].eqNullSafe(to["_of"]), "left")
    value = F.when(F.col("_there"), F.col("_to")).otherwise(F.raise_error(F.concat(F.lit("no value for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    return found.withColumn(name, value).drop("_of", "_to", "_there")


def with_pathology(df: DataFrame) -> DataFrame:
    """df with pathology_flag, unknown until findings are there."""
    return df.withColumn("pathology_flag", F.lit("unknown"))


def chain_reason(label: Column, reply: Column, motion: Column, anomalous: Column, symmetry: Column) -> Column:
    """Why a first reading is followed up (uncertainty, quality_flags) or not (derivative, error, confident)."""
    flags = F.coalesce(motion, F.lit(False)) | (F.coalesce(anomalous, F.lit(0)) > 0) | (F.coalesce(symmetry, F.lit(1.0)) < 0.90)
    failed = reply.isNull() | reply.startswith("[") | reply.startswith("Error")
    doubt = F.coalesce(text.hedges(reply), F.lit(False))
    derived = F.coalesce(text.is_derived(label), F.lit(False))
    return F.when(derived, "derivative").when(failed, "error").when(doubt, "uncertainty").when(flags, "quality_flags").otherwise("confident")
