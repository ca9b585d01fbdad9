"""Leakage-free splits and seeded samples: ranks by a seeded sha-256 inside strata, the same in any engine and run."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: runs of a global order; each holds this part of the rows
RUNS = 65536


def seeded(seed: int | str, *ids: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]), 256)


def stratum(df: DataFrame, columns: list[str], least: int = 2) -> DataFrame:
    """df with `_stratum`: the columns' values joined, __null__ for null; strata of fewer than `least` rows become __other__."""
    there = [c for c in columns if c in df.columns]
    if len(there) < len(columns):
        warnings.warn(f"no columns {sorted(set(columns) - set(there))}: not stratified by them", stacklevel=3)
    label = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("__null__")) for c in there]) if there else F.lit("__all__")
    df = df.withColumn("_stratum", label)
    # counts by a partial aggregate and a join: no window over a large stratum
    few = df.groupBy("_stratum").count().where(F.col("count") < least).select(F.col("_stratum").alias("_few"))
    return df.join(few, df["_stratum"] == few["_few"], "left").withColumn("_stratum", F.when(F.col("_few").isNotNull(), "__other__").otherwise(F.col("_stratum"))).drop("_few")


def ranked(df: DataFrame, by: str, seed: int | str, key: str) -> DataFrame:
    """df with `_rank` (from 1, in seeded order) among the rows of its value of `by`, and `_n`, their number.

    The hash's first digits cut each value's rows into 65,536 runs in order. Runs are counted, added up over the runs
    before them and numbered on their own, so no task sorts all rows of a frequent value.
    """
    rows = df.withColumn("_hash", seeded(seed, key)).withColumn("_run", F.substring("_hash", 1, 4))
    runs = rows.groupBy(by, "_run").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col(by).alias("_of"), F.col("_run").alias("_r"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(Window.partitionBy(by)).alias("_n"))
    out = rows.join(runs, rows[by].eqNullSafe(runs["_of"]) & (rows["_run"] == runs["_r"]))
    own = F.row_number().over(Window.partitionBy(by, "_run").orderBy("_hash", key))
    return out.withColumn("_rank", own + F.col("_before")).drop("_hash", "_run", "_of", "_r", "_before")


def assign(studies: DataFrame, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42, stratify: list[str] | None = None, key: str = "study_id") -> DataFrame:
    """studies with `split`: the first `held` rows are test, the next ones val, the rest train.

    Rows are ordered by their place inside their stratum as a share of it, in seeded order, so every stratum gives in
    proportion to its size while the totals are exact: round(n * test) of all, then round(rest * val / (val + train)) of
    the rest, each at least one and at most all but one (of one row none is held out).
    """
    if len(ratios) != 3 or min(ratios) <= 0 or abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios: three positive numbers with sum 1")
    if "split" in studies.columns:
        warnings.warn("there is a split column: unchanged", stacklevel=2)
        return studies
    rows = ranked(stratum(studies, stratify or []), "_stratum", seed, key)
    rows = rows.withColumn("_at", (F.col("_rank") - 0.5) / F.col("_n")).withColumn("_run", F.floor(F.col("_at") * RUNS))
    rows = rows.withColumn("_hash", seeded(seed, key)).drop("_n")
    # at most RUNS counts, added up in order; then each run numbers its own rows
    runs = rows.groupBy("_run").agg(F.count("*").alias("_c"))
    every = Window.partitionBy(F.lit(1))
    before = every.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("_run").alias("_r"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(every).alias("_n"))
    own = F.row_number().over(Window.partitionBy("_run").orderBy("_at", "_hash", key))
    rows = rows.join(F.broadcast(runs), F.col("_run") == F.col("_r")).withColumn("_place", own + F.col("_before"))
    test = held(F.col("_n"), ratios[2])
    val = held(F.col("_n") - test, ratios[1] / (ratios[0] + ratios[1]))
    split = F.when(F.col("_place") <= test, "test").when(F.col("_place") <= test + val, "val").otherwise("train")
    return rows.withColumn("split", split).drop("_stratum", "_rank", "_at", "_run", "_hash", "_r", "_before", "_n", "_place")


def held(n: Column, share: float) -> Column:
    """round(n * share), at least one and at most n - 1."""
    return F.greatest(F.lit(0), F.least(F.greatest(F.lit(1), F.bround(n * F.lit(share)).cast("long")), n - 1))


def propagate(series: DataFrame, splits: DataFrame, key: str = "study_id") -> DataFrame:
    """Series with the split of their study, so no study is in two splits."""
    return series.join(splits.select(key, "split"), key, "left")


def summary(splits: DataFrame, by: list[str]) -> DataFrame:
    """Counts by split, and by split with each of the columns: one pass with grouping sets. kind: all or the column."""
    rows = splits.select("split", *[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in by])
    out = rows.groupingSets([["split"], *[["split", c] for c in by]], "split", *by).agg(F.count("*").alias("n"))
    kind = F.coalesce(*[F.when(F.col(c).isNotNull(), c) for c in by], F.lit("all"))
    return out.select("split", kind.alias("kind"), F.coalesce(*by, F.lit("")).alias("name"), "n")


def stratified_sample(df: DataFrame, column: str, total: int, seed: int, key: str) -> DataFrame:
    """About `total` rows, each value of the column with its share (rounded, at least one row)."""
    rows = ranked(df, column, seed, key).join(F.broadcast(df.agg(F.count("*").alias("_all"))))  # one row
    quota = F.greatest(F.lit(1), F.least(F.col("_n"), F.floor(F.col("_n") * total / F.col("_all") + 0.5)))
    return rows.where(F.col("_rank") <= quota).drop("_rank", "_n", "_all")


def seeded_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows in seeded order: a top-n per task, then of these."""
    return df.orderBy(seeded(seed, key), key).limit(n)
