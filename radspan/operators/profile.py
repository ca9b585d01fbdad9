"""Column profiles, breakdowns and their counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.operators import ranks

#: Distinct values that are broadcast at most.
BROADCAST_ROWS = 100_000


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, nulls, null_pct, n_unique (null counts as a value): one aggregate for all columns, then unpivoted."""
    columns = columns or df.columns
    aggs = [F.struct(F.count_if(F.col(c).isNull()).alias("nulls"), (F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias("u")).alias(c) for c in columns]
    row = df.agg(F.count("*").alias("_n"), *aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.nulls").alias("nulls"), (F.col(f"{c}.nulls") * 100.0 / F.col("_n")).alias("null_pct"), F.col(f"{c}.u").alias("n_unique")) for c in columns])
    return row.select(F.inline(pairs))


def _number(column: str) -> Column:
    """The column as a double; NaN is no value."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """min, max, mean, median, sample deviation, nearest-rank quartiles (the row at round(q * (n - 1))) of each column. NaN is no
    value; the mean of infinities of both signs, and the deviation with any infinity, are NaN.

    The columns are unpivoted, so that two scans of the table serve all of them, however many there are.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _number(c).alias("v")) for c in columns])).alias("x")).select("x.*")
    stats = [F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")]
    wanted = {"_a": ranks.below(0.5), "_b": ranks.above(0.5), "p25": ranks.nearest(0.25), "p75": ranks.nearest(0.75)}
    found = ranks.order_statistics(long, "column", "v", wanted, stats)
    every = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))
    return F.broadcast(every).join(found, "column", "left").select("column", "min", "max", "mean", ((F.col("_a") + F.col("_b")) / 2).alias("median"), "std", "p25", "p75")


def string_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """unique values, the most frequent one (of ties the first) with its count, mean length in characters."""
    out = []
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n"))
        out.append(counts.agg(F.lit(c).alias("column"), F.count("*").alias("n_unique"), F.min(F.struct((-F.col("n")).alias("m"), "v")).alias("top"), (F.sum(F.char_length("v") * F.col("n")) / F.sum("n")).alias("mean_length")).select("column", "n_unique", F.col("top.v").alias("most_frequent"), (-F.col("top.m")).alias("frequency"), "mean_length"))
    return reduce(DataFrame.unionByName, out)


def breakdown(df: DataFrame, key: Column, most: int = 10) -> DataFrame:
    """The most frequent keys, of ties the first; a top-k, no full sort."""
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key").limit(most)


def month_histogram(df: DataFrame, day: str, amount: str | None = None) -> DataFrame:
    return df.groupBy(F.substring(F.col(day).cast("string"), 1, 7).alias("month")).agg((F.count("*") if amount is None else F.sum(amount)).alias("n"))


def keyword_buckets(df: DataFrame, text: Column, words: list[str], amount: Column) -> DataFrame:
    """Amounts by the first keyword that the text contains, else Other."""
    bucket = F.lit("Other")
    for w in reversed(words):
        bucket = F.when(F.contains(F.lower(text), F.lit(w.lower())), w).otherwise(bucket)
    return df.groupBy(bucket.alias("bucket")).agg(F.sum(amount).alias("n"))


def coverage_matrix(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """For each value of `columns` its count, spread over the values of `rows` by their share and cut to a whole number."""
    counted = df.groupBy(F.col(columns).alias("column")).agg(F.count("*").alias("_c"))
    shares = df.groupBy(F.col(rows).alias("row")).agg(F.count("*").alias("_r"))
    shares = shares.withColumn("_share", F.col("_r") / F.sum("_r").over(Window.partitionBy(F.lit(1))))
    # the result has a row for each pair of distinct values; the shares are broadcast only if they are few
    few = F.broadcast(shares) if shares.count() <= BROADCAST_ROWS else shares
    return counted.join(few).select("row", "column", F.floor(F.col("_c") * F.col("_share") + 1e-9).alias("n"))
