"""Order statistics of many groups at once, exactly, in two passes over the rows.

1. One pass gives each group's count and, by mergeable quantile sketches, a bracket of values around every quantile
   asked for: the sketch is off by n / ACCURACY ranks at most, the bracket reaches SLACK times as far. Groups of fewer than
   ACCURACY values have all their values in the bracket.
2. One pass counts the values below each bracket (a single number) and the distinct values inside it.

What is then ordered in a window is the distinct values of one bracket: about 2 * SLACK / ACCURACY of a group.
Nulls and NaN are no values; infinities stand at the ends.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.sources.scratch import work_table

ACCURACY, SLACK = 10_000, 3
#: Brackets of at most so many groups are broadcast.
BROADCAST_ROWS = 100_000


class Rank(NamedTuple):
    """The value at place(n), from 0, in the order of a group's n values; place is within one of quantile * (n - 1)."""

    quantile: float
    place: Callable[[Column], Column]


def below(q: float) -> Rank:
    return Rank(q, lambda n: F.floor(q * (n - 1)).cast("long"))


def above(q: float) -> Rank:
    return Rank(q, lambda n: F.ceil(q * (n - 1)).cast("long"))


def nearest(q: float) -> Rank:
    """Halves go up."""
    return Rank(q, lambda n: F.floor(q * (n - 1) + 0.5).cast("long"))


def order_statistics(rows: DataFrame, group: str, value: str, ranks: dict[str, Rank], more: list[Column] = []) -> DataFrame:
    """group, n, the aggregates `more` of the rows of a group, and the value at each rank. Every group of the rows has its row."""
    v = F.col(value).cast("double")
    rows = rows.withColumn(value, F.when(~F.isnan(v), v))
    quantiles = sorted({r.quantile for r in ranks.values()})
    reach = SLACK / ACCURACY
    ends = [F.lit(x) for q in quantiles for x in (max(0.0, q - reach), min(1.0, q + reach))]
    sketch = F.percentile_approx(value, F.array(*ends), ACCURACY)
    stats = work_table(rows.groupBy(group).agg(F.count(value).alias("n"), F.min(value).alias("_min"), F.max(value).alias("_max"), sketch.alias("_at"), *more), "groups")
    few = F.col("n") < ACCURACY
    sides = [F.struct(F.lit(k).alias("k"), F.when(few, F.col("_min")).otherwise(F.get("_at", F.lit(2 * k))).alias("low"), F.when(few, F.col("_max")).otherwise(F.get("_at", F.lit(2 * k + 1))).alias("high")) for k in range(len(quantiles))]
    brackets = stats.where("n > 0").select(group, F.array(*sides).alias("_b"))
    if stats.count() <= BROADCAST_ROWS:
        brackets = F.broadcast(brackets)
    met = rows.where(F.col(value).isNotNull()).select(group, value).join(brackets, group)
    met = met.select(group, value, F.explode(F.filter("_b", lambda b: F.col(value) <= b["high"])).alias("b"))
    inside = met.groupBy(group, F.col("b.k").alias("k"), F.when(F.col(value) >= F.col("b.low"), F.col(value)).alias("v")).agg(F.count("*").alias("c"))  # null: all below
    order = Window.partitionBy(group, "k").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = work_table(inside, "inside").withColumn("upto", F.sum("c").over(order)).join(stats.select(group, "n"), group)
    at = [F.min(F.when((F.col("k") == quantiles.index(r.quantile)) & (F.col("upto") > r.place(F.col("n"))), F.col("v"))).alias(name) for name, r in ranks.items()]
    return stats.drop("_min", "_max", "_at").join(found.groupBy(group).agg(*at), group, "left")


def percentiles(rows: DataFrame, group: str, value: str, wanted: dict[str, float], more: list[Column] = []) -> DataFrame:
    """group, n, the aggregates `more`, and percentiles with linear interpolation between neighbours; wanted: name to q of 0..1."""
    ends = {f"_{name}_{side}": make(q) for name, q in wanted.items() for side, make in (("a", below), ("b", above))}
    found = order_statistics(rows, group, value, ends, more)
    for name, q in wanted.items():
        at, a, b = F.lit(q) * (F.col("n") - 1), F.col(f"_{name}_a"), F.col(f"_{name}_b")
        found = found.withColumn(name, F.when(a == b, a).otherwise(a + (b - a) * (at - F.floor(at))))
    return found.drop(*ends)
