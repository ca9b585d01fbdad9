"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import work_table


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them; links: u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    handed = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: for every node of the links the smallest node that it reaches."""
    at = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    at = work_table(at, "links")
    while True:
        at = work_table(_small_star(_large_star(at)), "stars")
        # done when every node has one link, to a node that has none: only stars are left
        if at.join(at.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty() and at.groupBy("u").count().where("count > 1").isEmpty():
            return at.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(at.select("v", "v").distinct().toDF("id", "component"))
