"""Cohort filters over series or study tables. All are narrow predicates that reach the scan, or one semi-join."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.functions.scoring import GRADES


def sequence_contains(df: DataFrame, keyword: str, column: str = "sequence_type") -> DataFrame:
    """Rows whose type matches the keyword (a regular expression, any case); without the column: none, with a warning."""
    if column not in df.columns:
        warnings.warn(f"no column {column}: empty cohort", stacklevel=2)
        return df.limit(0)
    return df.where(F.lower(column).rlike(keyword.lower()))


def swan_only(df: DataFrame, column: str = "sequence_type") -> DataFrame:
    return sequence_contains(df, "swan|swi", column)


def grade_at_least(df: DataFrame, grade: str, columns: tuple[str, ...] = ("quality_grade", "dominant_grade")) -> DataFrame:
    """Rows of this grade or a better one; without a grade column: unchanged, with a warning."""
    if grade not in GRADES:
        raise ValueError(f"unknown grade {grade!r}")
    found = next((c for c in columns if c in df.columns), None)
    if found is None:
        warnings.warn("no grade column: cohort unchanged", stacklevel=2)
        return df
    return df.where(F.col(found).isin(GRADES[: GRADES.index(grade) + 1]))


def single_vendor(df: DataFrame, vendor: str, columns: tuple[str, ...] = ("vendor", "manufacturer")) -> DataFrame:
    found = next((c for c in columns if c in df.columns), None)
    if found is None:
        warnings.warn("no vendor column: cohort unchanged", stacklevel=2)
        return df
    return df.where(F.lower(found) == vendor.lower())


def single_field(df: DataFrame, strength: float, column: str = "field_strength_T", tolerance: float = 0.05) -> DataFrame:
    """Rows within the tolerance of a field strength."""
    return df.where(F.abs(F.col(column) - F.lit(strength)) <= tolerance)


def covers(sequences: Column, required: list[str]) -> Column:
    """Every required word occurs in some element of the array; false for a null or empty array."""
    out = F.lit(True)
    for word in required:
        out = out & F.coalesce(F.exists(sequences, _containing(word.lower())), F.lit(False))
    return out


def _containing(word: str):
    return lambda s: F.contains(F.lower(s), F.lit(word))


def complete_protocol_studies(df: DataFrame, required: list[str], column: str = "sequences_present") -> DataFrame:
    return df.where(covers(F.col(column), required))


def complete_protocol_series(df: DataFrame, required: list[str], study: str = "study_id", column: str = "sequence_type") -> DataFrame:
    """All rows of the studies whose series together cover the required words: one aggregate of flags, one semi-join."""
    flags = [F.coalesce(F.bool_or(F.contains(F.lower(column), F.lit(w.lower()))), F.lit(False)).alias(f"_has{i}") for i, w in enumerate(required)]
    whole = df.groupBy(study).agg(*flags)
    for i in range(len(required)):
        whole = whole.where(f"_has{i}")
    return df.join(whole.select(study), study, "left_semi")


def with_both(df: DataFrame, first: str, second: str, study: str = "study_id", column: str = "sequence_type") -> DataFrame:
    """All rows of the studies that have both exact types."""
    return df.join(df.groupBy(study).agg(F.bool_or(F.col(column) == first).alias("_a"), F.bool_or(F.col(column) == second).alias("_b")).where("_a and _b").select(study), study, "left_semi")


def exact(df: DataFrame, sequence: str | None = None, grades: list[str] | None = None, column: str = "sequence_type", grade: str = "quality_grade") -> DataFrame:
    """Equality of any case on the type, membership on the grade; unlike sequence_contains() no substring."""
    if sequence is not None:
        df = df.where(F.upper(column) == sequence.upper())
    return df if grades is None else df.where(F.upper(grade).isin([g.upper() for g in grades]))


def since(df: DataFrame, day: str, column: str = "study_date") -> DataFrame:
    return df.where(F.col(column) >= F.lit(day).cast(df.schema[column].dataType)) if column in df.columns else df


def bucket_of(uid: Column, buckets: int = 10) -> Column:
    """A stable bucket from a sha-256 of the id."""
    return F.pmod(F.conv(F.substring(F.sha2(uid.cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def split_member(df: DataFrame, split: str, uid: str = "series_uid") -> DataFrame:
    """test: bucket 0, validation (or val): 1, train: the others; any other name: all rows."""
    b = bucket_of(F.col(uid))
    rules = {"test": b == 0, "validation": b == 1, "val": b == 1, "train": b >= 2}
    return df.where(rules[split]) if split in rules else df


def pending(work: DataFrame, done: DataFrame, key: str, skip: Column | None = None) -> DataFrame:
    """Work without a result yet, and not to be skipped."""
    left = work.join(done.select(key).distinct(), key, "left_anti")
    return left if skip is None else left.where(~F.coalesce(skip, F.lit(False)))


def quality_skip(advanced: Column, files: Column, least: int = 3) -> Column:
    """Why a series gets no advanced quality: it has it, or has too few files; null if it is to be done."""
    n = F.greatest(F.coalesce(F.size(files), F.lit(0)), F.lit(0))
    return F.when(advanced.isNotNull(), "done").when(n < least, F.concat(F.lit("too_few_files ("), n.cast("string"), F.lit(")")))


def acceptable(confidence: Column, reply: Column) -> Column:
    """A reply counts unless it is missing or its confidence is low; no confidence given counts as sure."""
    return reply.isNotNull() & (F.lower(F.coalesce(confidence, F.lit(""))) != "low")
