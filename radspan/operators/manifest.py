"""Roll-ups from series to studies and to the dataset: one grouped aggregate each, with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.functions import scoring

# fixed values: study flags and the words (any of them) that set them
FLAGS = {"has_dwi": ["dwi"], "has_flair": ["flair"], "has_swan": ["swan", "swi"], "has_tof": ["tof"], "has_t1": ["t1"], "has_t2": ["t2"]}
LOW_CONFIDENCE = 0.6


def any_contains(column: str, words: list[str]) -> Column:
    """Some value contains one of the words; false if there is none."""
    return F.coalesce(F.bool_or(F.lower(column).rlike("|".join(words))), F.lit(False))


def study_rollup(series: DataFrame, flags: dict[str, list[str]] = FLAGS, study: str = "study_id", sequence: str = "sequence_type", files: str = "file_count", grade: str = "quality_grade", score: str = "ml_score") -> DataFrame:
    """One row per study. The dominant grade is the most frequent one, of ties the first in the alphabet."""
    return series.groupBy(study).agg(
        F.count("*").alias("n_series"),
        F.sort_array(F.collect_set(sequence)).alias("sequences_present"),
        F.sum(F.col(files).cast("long")).alias("total_files"),
        F.mode(grade, deterministic=True).alias("dominant_grade"),
        F.avg(score).alias("mean_ml_score"),
        *[any_contains(sequence, words).alias(name) for name, words in flags.items()],
    )


def confidence_rollup(annotations: DataFrame, by: list[str], confidence: str = "confidence", escalate: str = "needs_escalation", premium: str = "premium_used", low: float = LOW_CONFIDENCE) -> DataFrame:
    """Counts and confidence per group over rows with a confidence; without rows all figures are 0."""
    rows = annotations.where(F.col(confidence).isNotNull())
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_series"),
        zero(F.avg(confidence)).alias("mean_confidence"),
        zero(F.min(F.col(confidence).cast("double"))).alias("min_confidence"),
        zero(F.avg((F.col(confidence) < low).cast("double"))).alias("pct_low_confidence"),
        F.count_if(F.coalesce(F.col(escalate), F.lit(False))).alias("n_needs_escalation"),
        zero(F.avg(F.coalesce(F.col(premium), F.lit(False)).cast("double"))).alias("pct_premium_used"),
    )


def study_manifest(series: DataFrame, annotations: DataFrame, listing: DataFrame, flags: dict[str, list[str]] = FLAGS, study: str = "study_id", path: str = "path", size: str = "bytes", **columns: str) -> DataFrame:
    """study_rollup() with the study's archive and the confidence of its annotations, one row per study.

    listing: paths below the root and sizes in bytes; a study's archive is `<study>/<study>.slices.tar`. Without one,
    its path and size are null; without annotations, the confidence figures are 0. All three sides are grouped by the
    study first, so the joins use the partitioning of the groups.
    """
    owner = F.regexp_extract(path, r"^([^/]+)/\1\.slices\.tar$", 1)
    archives = listing.withColumn("_study", owner).where("_study <> ''").groupBy("_study").agg((F.max(size) / (1024 * 1024)).alias("total_size_mb"), F.min(path).alias("tar_shard_path"))
    sure = confidence_rollup(annotations, [study])
    renamed = {"n_series": "confidence_n_series", "mean_confidence": "confidence_mean", "min_confidence": "confidence_min", "pct_low_confidence": "confidence_pct_low", "n_needs_escalation": "confidence_n_needs_escalation", "pct_premium_used": "confidence_pct_premium_used"}
    sure = sure.select(F.col(study).cast("string").alias("_sure"), *[F.col(a).alias(b) for a, b in renamed.items()])
    out = study_rollup(series, flags, study, **columns).withColumn("_key", F.col(study).cast("string"))
    out = out.join(archives, F.col("_key") == F.col("_study"), "left").join(sure, F.col("_key") == F.col("_sure"), "left")
    return out.fillna(0, list(renamed.values())).drop("_key", "_study", "_sure")


def dataset_rollup(series: DataFrame, sequence: str = "sequence_type", grade: str = "quality_grade", validated: Column | None = None, files: str = "file_count") -> DataFrame:
    """Sequence and known-grade counts, validated series and files, in long form: kind, name, n."""
    kind = F.when(F.grouping_id() == 1, "sequence").when(F.grouping_id() == 2, "grade").otherwise("all")
    rows = series.select(F.col(sequence).alias("_s"), F.col(grade).alias("_g"), F.col(files).cast("long").alias("_f"), (F.lit(True) if validated is None else validated).alias("_v"))
    out = rows.groupingSets([["_s"], ["_g"], []], "_s", "_g").agg(kind.alias("kind"), F.coalesce("_s", "_g", F.lit("")).alias("name"), F.count("*").alias("n"), F.count_if("_v").alias("n_validated"), F.sum("_f").alias("n_files"))
    return out.where((F.col("kind") != "grade") | F.col("name").isin(scoring.GRADES)).select("kind", "name", "n", "n_validated", "n_files")


def study_grade(series: DataFrame, study: str = "study_id", score: str = "score", grade: str = "quality_grade") -> DataFrame:
    """0.7 of the mean and 0.3 of the worst score, its letter, and how often each letter occurs."""
    out = series.groupBy(study).agg(F.avg(score).alias("avg_score"), F.min(score).alias("worst_score"), F.max(score).alias("best_score"), F.count("*").alias("n_series"), *[F.count_if(F.col(grade) == g).alias(f"n_{g.lower()}") for g in scoring.GRADES])
    out = out.withColumn("score", F.col("avg_score") * F.lit(0.7) + F.col("worst_score") * F.lit(0.3))
    return out.withColumn("grade", scoring.letter(F.col("score")))


def replaced_strict(df: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    """df with the column's values replaced; a value without a name (but not a null) ends the job with an error."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = F.try_element_at(known, F.col(column))
    return df.withColumn(column, F.when(F.col(column).isNotNull() & found.isNull(), F.raise_error(F.concat(F.lit("no name for "), F.col(column)))).otherwise(found))


def series_with_study(series: DataFrame, studies: DataFrame, key: str = "study_id", prefix: str = "study_") -> DataFrame:
    """Series with the columns of their study under a prefix; series without a study stay."""
    renamed = studies.select(F.col(key), *[F.col(c).alias(f"{prefix}{c}") for c in studies.columns if c != key])
    return series.join(renamed, key, "left")
