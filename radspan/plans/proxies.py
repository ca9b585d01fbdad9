"""The driver's tables in the roles of studies and series, as DataFrames and as SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.functions.scoring import cuts_sql, letter

SCORE = "l_quantity * 2"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as series: type and description from the part, a score from the quantity."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    score = F.col("l_quantity") * 2
    return rows.select(F.col("l_orderkey").alias("study_id"), F.col("l_partkey").alias("series_key"), F.col("l_linenumber").alias("file_count"), F.col("p_type").alias("sequence_type"), F.col("p_name").alias("series_description"), score.alias("score"), letter(score).alias("quality_grade"), F.col("l_discount").alias("field_strength_T"), F.col("l_extendedprice").alias("price"))


SERIES = f"series AS (SELECT l_orderkey AS study_id, l_partkey AS series_key, l_linenumber AS file_count, p_type AS sequence_type, p_name AS series_description, {SCORE} AS score, {cuts_sql(SCORE)} AS quality_grade, l_discount AS field_strength_T, l_extendedprice AS price FROM lineitem JOIN part ON l_partkey = p_partkey)"


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as studies: the market segment as vendor, the order's state as grade."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(F.col("o_orderkey").alias("study_id"), F.col("c_mktsegment").alias("vendor"), F.col("o_orderstatus").alias("dominant_grade"), F.col("o_orderdate").cast("date").alias("study_date"), F.col("o_totalprice").alias("price"))


STUDIES = "studies AS (SELECT o_orderkey AS study_id, c_mktsegment AS vendor, o_orderstatus AS dominant_grade, CAST(o_orderdate AS DATE) AS study_date, o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey)"
