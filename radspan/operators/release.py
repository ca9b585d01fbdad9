"""Release of studies: every file goes through the same stages, each with the outcome that was seen, and a study goes out only whole.

What was done is recorded per file and never assumed: a file of which nothing tells that it was defaced is `skipped` there,
whatever was asked for. A file that fails holds back its own study and no other. `run` keeps the outcomes by study, so a
second run reads only studies whose files changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.operators import privacy, summaries
from radspan.sources import cache

STAGES = ("ingest", "deface", "deidentify", "verify", "validate")
OUTCOMES = ("done", "skipped", "failed", "not_reached")
#: files whose checksums stand in one part of a custody document
PART_FILES = 1000


def outcomes(files: DataFrame, study: str, path: str, tags: str, error: str, patient: Column, salt: str, defaced: str | None = None, burned: str | None = None, sets: dict[str, list[str]] = privacy.PROFILE, scrubbed: dict[str, str] = privacy.SCRUB, scanned: dict[str, str] = privacy.SCAN, ignored: list[str] = privacy.SKIPPED) -> DataFrame:
    """study, path, tags (cleaned), stages (stage, outcome, detail), ok, identifiers, sha256, counts: one row for each of files.

    A file with an error or without tags fails `ingest`. defaced: true is done, false failed, null (or no such column)
    skipped. `verify` fails if a tag that had to go is left; `validate` if a scan finds identifiers, or `burned` tells of text
    in the picture. After a failure the stages that need its result are not reached, and tags are null if there are none.
    """
    given = F.col(tags)
    dates = [*sets["dates"], *sets["datetimes"]]
    base = files.select(F.col(study).alias("study"), F.col(path).cast("string").alias("path"), given.alias("_was"), F.coalesce(F.col(error).cast("string"), F.when(given.isNull(), "no tags")).alias("_error"), (F.col(defaced) if defaced else F.lit(None)).cast("boolean").alias("_defaced"), F.coalesce(F.col(burned) if burned else F.lit(False), F.lit(False)).alias("_burned"), given.alias("tags"), patient.alias("_patient"))
    read = F.col("_error").isNull()
    clean = privacy.deidentified(base, "tags", F.col("_patient"), salt, sets["remove"], sets["blank"], sets["uids"], dates, sets["free"], scrubbed).withColumn("tags", F.when(read, F.col("tags")))
    values = F.map_values(F.map_filter("tags", lambda k, v: ~k.isin(ignored or [""]) & (F.length(v) >= 3)))
    hits = F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + privacy.match_count(v, scanned))
    private = F.filter(F.map_keys("_was"), lambda t: F.coalesce(privacy._private(t), F.lit(False)))
    counts = summaries.change_counts(F.col("_was"), F.col("tags"), sets["remove"], sets["blank"], sets["uids"], dates, private)
    entries = F.array_sort(F.map_entries("tags"))
    whole = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(F.concat(F.length(e["value"]).cast("string"), F.lit(":"), e["value"]), F.lit("null")))), "\n")
    seen = clean.withColumns({"identifiers": F.when(read, hits), "_clean": privacy.verified_clean(F.col("tags"), sets["remove"], sets["blank"]), "sha256": F.when(read, F.sha2(whole, 256)), "counts": F.when(read, F.struct(*[c.alias(n) for n, c in counts.items()]))})
    passed = F.col("_clean") & (F.col("identifiers") == 0) & ~F.col("_burned")
    told = F.concat_ws(", ", F.when(F.col("identifiers") > 0, F.concat(F.col("identifiers").cast("string"), F.lit(" identifiers"))), F.when(F.col("_burned"), F.lit("text in the picture")))
    later = lambda outcome: F.when(~read, "not_reached").otherwise(outcome)
    stages = F.array(
        _stage("ingest", F.when(read, "done").otherwise("failed"), F.col("_error")),
        _stage("deface", later(F.when(F.col("_defaced").isNull(), "skipped").when(F.col("_defaced"), "done").otherwise("failed")), F.when(read & F.col("_defaced").isNull(), F.lit("no record"))),
        _stage("deidentify", later(F.lit("done"))),
        _stage("verify", later(F.when(F.col("_clean"), "done").otherwise("failed")), F.when(read & ~F.col("_clean"), F.lit("tags left"))),
        _stage("validate", later(F.when(~F.col("_clean"), "not_reached").when(passed, "done").otherwise("failed")), F.when(read & F.col("_clean") & (told != ""), told)),
    )
    ok = read & passed & F.coalesce(F.col("_defaced"), F.lit(True))
    return seen.select("study", "path", "tags", stages.alias("stages"), ok.alias("ok"), "identifiers", "sha256", "counts")


def _stage(name: str, outcome: Column, detail: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(name).alias("stage"), outcome.alias("outcome"), (none if detail is None else F.coalesce(detail, none)).alias("detail"))


def report(seen: DataFrame) -> DataFrame:
    """study, stage, done, skipped, failed, not_reached, released: a row for each study and stage; `export` is done for all files or none.

    Files without a study form a group of their own. One grouped aggregate of counts, so a study of any size is no single task.
    """
    per = seen.groupBy("study").agg(F.count("*").alias("_n"), F.bool_and("ok").alias("released"), *[F.count_if(F.col("stages")[i]["outcome"] == o).alias(f"_{s}_{o}") for i, s in enumerate(STAGES) for o in OUTCOMES])
    none = F.lit(0).cast("long")
    row = lambda s, values: F.struct(F.lit(s).alias("stage"), *[v.alias(o) for o, v in zip(OUTCOMES, values, strict=True)])
    export = row("export", [F.when(F.col("released"), F.col("_n")).otherwise(0), none, none, F.when(F.col("released"), none).otherwise(F.col("_n"))])
    return per.select("study", "released", F.inline(F.array(*[row(s, [F.col(f"_{s}_{o}") for o in OUTCOMES]) for s in STAGES], export)))


def held(seen: DataFrame, most: int = 20) -> DataFrame:
    """study, files, reasons: studies that are held back, their failing files and at most `most` different reasons, smallest first."""
    bad = seen.where(~F.col("ok")).select("study", "path", F.explode(F.filter("stages", lambda s: s["outcome"] == "failed")).alias("s"))
    lines = bad.groupBy("study", F.concat_ws(": ", "s.stage", "s.detail").alias("_line")).agg(F.count_distinct("path").alias("_n"))
    files = bad.groupBy("study").agg(F.count_distinct("path").alias("files"))
    told = lines.groupBy("study").agg(F.slice(F.array_sort(F.collect_set("_line")), 1, most).alias("reasons")).withColumnRenamed("study", "_study")
    return files.join(told, F.col("study").eqNullSafe(F.col("_study"))).drop("_study")


def custody_heads(seen: DataFrame, part_files: int = PART_FILES) -> DataFrame:
    """A row for each study: source_archive_id (one way, without the time), output_file_count, defacing_applied, validation_passed,
    the changes added up, parts of its checksums, and their fingerprint, which no order of the files changes."""
    outcome = lambda s: F.col("stages")[STAGES.index(s)]["outcome"]
    word = F.conv(F.substring(F.sha2(F.concat_ws(" ", "path", "sha256"), 256), 1, 15), 16, 10).cast("long")
    names = [f.name for f in seen.schema["counts"].dataType.fields]
    return seen.groupBy("study").agg(
        F.count("*").alias("output_file_count"),
        F.bool_and(outcome("deface") == "done").alias("defacing_applied"),
        F.bool_and("ok").alias("validation_passed"),
        *[F.coalesce(F.sum(f"counts.{n}"), F.lit(0)).alias(n) for n in names],
        F.ceil(F.count("*") / part_files).cast("long").alias("parts"),
        F.lower(F.hex(F.bit_xor(word))).alias("fingerprint"),
    ).withColumn("source_archive_id", F.substring(F.sha2(F.coalesce(F.col("study").cast("string"), F.lit("")), 256), 1, 16))


def custody_documents(seen: DataFrame, part_files: int = PART_FILES) -> DataFrame:
    """study, part, document: JSON texts. Part 0 is the head, the others hold the checksums of about part_files files each, by path.

    Files are dealt to parts by a hash of their path, so no text holds a study of any size.
    """
    heads = custody_heads(seen, part_files)
    fields = [c for c in heads.columns if c != "study"]
    first = heads.select("study", F.lit(0).cast("long").alias("part"), F.to_json(F.struct("study", *sorted(fields))).alias("document"))
    sizes = heads.select(F.col("study").alias("_study"), "parts")
    dealt = seen.join(sizes, F.col("study").eqNullSafe(F.col("_study"))).withColumn("part", 1 + F.pmod(F.xxhash64("path"), F.col("parts")))
    sums = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    rest = dealt.groupBy("study", "part").agg(sums.alias("checksums"))
    return first.unionByName(rest.select("study", "part", F.to_json(F.struct("study", "part", "checksums")).alias("document")))


def clean_path(tags: Column) -> Column:
    """`<date>_<modality>/<number>_<description>/<instance>.dcm` from a tag map; what a name may not hold goes, 50 characters at most."""
    value = lambda t, missing: F.coalesce(F.try_element_at(tags, F.lit(t)), F.lit(missing))
    wide = lambda v, n: F.when(F.length(v) >= n, v).otherwise(F.lpad(v, n, "0"))

    def named(text: Column) -> Column:
        kept = F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w\s\-.]", ""), r"(?U)\s+", "_")
        short = F.substring(F.regexp_replace(kept, "^_+|_+$", ""), 1, 50)
        return F.when(short == "", "unknown").otherwise(short)

    study = named(F.concat_ws("_", value("StudyDate", "unknown"), value("Modality", "unknown")))
    series = named(F.concat_ws("_", wide(value("SeriesNumber", "0"), 4), value("SeriesDescription", "unknown")))
    return F.concat(study, F.lit("/"), series, F.lit("/"), wide(value("InstanceNumber", "0"), 6), F.lit(".dcm"))


def exports(seen: DataFrame) -> DataFrame:
    """study, path, target, clashes: where each file of a released study goes, and how many files go there.

    Files that clash are told, not overwritten: the writer has to add something of its own to their names.
    """
    whole = seen.groupBy("study").agg(F.bool_and("ok").alias("_all")).where("_all").select(F.col("study").alias("_study"))
    rows = seen.join(whole, F.col("study").eqNullSafe(F.col("_study")), "left_semi").select("study", "path", clean_path(F.col("tags")).alias("target"))
    n = rows.groupBy("target").agg(F.count("*").alias("clashes"))
    return rows.join(n, "target").select("study", "path", "target", "clashes")


def run(listed: DataFrame, root: str, study: str, read: Callable[[DataFrame], DataFrame], **how: object) -> DataFrame:
    """study, state (`new`, `changed`, `same`, `gone`): brings the outcomes at `root` up to what is listed, a row for each file there.

    read gets the listed files of new and changed studies and gives their rows for `outcomes`; `how` are its other arguments.
    A run that dies leaves what was there and is made up for by the next one. A folder belongs to one profile and salt:
    studies that did not change keep the outcomes of the run that wrote them. `cache.cached` reads them.
    """
    return cache.refresh(listed, root, study, lambda files: outcomes(read(files), study, **how).withColumnRenamed("study", study))
