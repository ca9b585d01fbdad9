"""Views for training: named configurations with splits, rows for loaders, and summaries of segmentations and stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.operators import cohorts, splits

# fixed values: configurations and the sequence word (or grade) that they keep
CONFIGS = {"all": None, "dwi": "dwi", "flair": "flair", "t1": "t1", "t2": "t2", "swan": "swan|swi", "tof": "tof"}


def config(series: DataFrame, name: str, assigned: DataFrame, split: str, study: str = "study_id") -> DataFrame:
    """The rows of a configuration and split (`val` and `validation` are one); grade_a keeps the best grade."""
    rows = cohorts.grade_at_least(series, "A") if name == "grade_a" else series if CONFIGS[name] is None else cohorts.sequence_contains(series, CONFIGS[name])
    split = {"validation": "val"}.get(split, split)
    return splits.propagate(rows, assigned, study).where(F.col("split") == split)


def loader_rows(series: DataFrame, image: Column, label: Column, transforms: dict[str, list[str]], otherwise: list[str], sequence: str = "sequence_type") -> DataFrame:
    """image, label, transforms of each series: those of the first key that its type contains."""
    steps = F.array(*map(F.lit, otherwise))
    for key, names in reversed(transforms.items()):
        steps = F.when(F.upper(sequence).contains(key.upper()), F.array(*map(F.lit, names))).otherwise(steps)
    return series.select(image.alias("image"), label.alias("label"), steps.alias("transforms"))


def segmentation_summary(df: DataFrame, flags: list[str], figures: list[str]) -> DataFrame:
    """Rows, true flags and means (0 without values); columns that are not there count as 0."""
    there = set(df.columns)
    return df.agg(
        F.count("*").alias("n_studies"),
        *[(F.count_if(F.coalesce(F.col(c), F.lit(False))) if c in there else F.lit(0).cast("long")).alias(f"n_{c}") for c in flags],
        *[(F.coalesce(F.avg(c), F.lit(0.0)) if c in there else F.lit(0.0)).alias(f"mean_{c}") for c in figures],
    )


def preferred_file(files: DataFrame, study: str, path: str, modality: str, order: list[str]) -> DataFrame:
    """The first path of the most preferred modality of each study."""
    rank = F.coalesce(*[F.when(F.col(modality) == m, F.lit(i)) for i, m in enumerate(order)], F.lit(len(order)))
    return files.groupBy(study).agg(F.min_by(F.struct(path, modality), F.struct(rank, F.col(path))).alias("f")).select(study, f"f.{path}", f"f.{modality}")


def tag_union(df: DataFrame, tags: str) -> DataFrame:
    """Each tag that occurs, in how many rows, and whether it is private."""
    rows = df.select(F.explode(F.map_keys(tags)).alias("tag"))
    private = F.col("tag").startswith("(") & (F.conv(F.substring("tag", 2, 4), 16, 10).cast("long") % 2 == 1)
    return rows.groupBy("tag").agg(F.count("*").alias("n")).withColumn("private", private)


def combined(reports: list[DataFrame]) -> DataFrame:
    """One row per report name and whether all its checks passed; reports: name, passed."""
    return reduce(DataFrame.unionByName, reports).groupBy("name").agg(F.bool_and("passed").alias("passed"))


def backfilled(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """df with missing values of these columns filled in; applying it again changes nothing."""
    there = set(df.columns)
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in there else v for c, v in values.items()})


def log_lines(df: DataFrame, time: str, stage: str, event: str) -> DataFrame:
    """One JSON line per row: time, stage and event first, then the other columns."""
    rest = [c for c in df.columns if c not in (time, stage, event)]
    return df.select(F.to_json(F.struct(F.col(time).alias("ts"), F.col(stage).alias("stage"), F.col(event).alias("event"), *rest)).alias("value"))
