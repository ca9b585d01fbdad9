"""Consensus of several annotators per series, escalation, routing cascades and their cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# fixed values: grades as numbers
GRADE_VALUE = {"A": 4, "B": 3, "C": 2, "D": 1, "F": 0}


def majority(votes: DataFrame, key: str, choice: str) -> DataFrame:
    """key, the most frequent choice (of ties the first in order), its share, and the number of votes."""
    counts = votes.groupBy(key, choice).agg(F.count("*").alias("_n"))
    out = counts.groupBy(key).agg(F.min(F.struct((-F.col("_n")).alias("m"), F.col(choice).alias("c"))).alias("top"), F.sum("_n").alias("n_votes"))
    return out.select(key, F.col("top.c").alias(choice), (-F.col("top.m") / F.col("n_votes")).alias("agreement"), "n_votes")


def confidence(sequence_agreement: Column, positive: Column, n: Column) -> Column:
    """0.6 of the agreement on the type and 0.4 of that on the finding; without votes on it, the type's alone."""
    other = F.greatest(positive, n - positive) / n
    return F.when(n > 0, F.lit(0.6) * sequence_agreement + F.lit(0.4) * other).otherwise(sequence_agreement)


def escalate(sequence_agreement: Column, positive: Column, n: Column) -> Column:
    """The type is split, or the finding has less than a two-thirds majority."""
    return (sequence_agreement <= 0.5) | F.coalesce((n > 0) & (F.greatest(positive, n - positive) / n < 0.67), F.lit(False))


def grade_mean(grades: Column) -> Column:
    """The letter of the mean grade, rounded half to even; no known grade counts as 0, which is F."""
    value = F.coalesce(*[F.when(grades == g, F.lit(v)) for g, v in GRADE_VALUE.items()])
    mean = F.bround(F.coalesce(F.avg(value), F.lit(0.0)), 0).cast("int")
    return F.coalesce(*[F.when(mean == v, F.lit(g)) for g, v in GRADE_VALUE.items()])


def ordered_union(values: Column, position: Column, most: int) -> Column:
    """An aggregate: the first `most` distinct values in the order of their first position."""
    pairs = F.array_sort(F.collect_list(F.struct(position.alias("p"), values.alias("v"))))
    return F.slice(F.array_distinct(F.transform(F.filter(pairs, lambda x: x["v"].isNotNull()), lambda x: x["v"])), 1, most)


def first_distinct(df: DataFrame, key: str, value: str, position: str, most: int) -> DataFrame:
    """As ordered_union(), for groups of any size: rows key, value, place (from 1)."""
    firsts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(position).alias("_at"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("_at", value))
    return firsts.withColumn("place", place).where(F.col("place") <= most).select(key, value, "place")


def annotation_summary(series: DataFrame, study: str, place: str, found: str, disagreements: str, findings: str, most: int = 20) -> DataFrame:
    """Per study: series, those with a finding, those with disagreement, whether to review, and the first `most` different findings.

    series: one row each, with an array of disagreements and one of structs location, signal_on_this_sequence, size_mm.
    Findings are the same if their location, signal and size are. place: the order of the series.
    """
    quarrels = F.coalesce(F.size(F.filter(disagreements, lambda x: x.isNotNull())), F.lit(0)) > 0
    counts = series.groupBy(study).agg(F.count("*").alias("total_series"), F.count_if(F.coalesce(F.col(found), F.lit(False))).alias("pathology_detected"), F.count_if(quarrels).alias("disagreements"))
    rows = series.select(study, F.col(place).alias("_p"), F.posexplode(findings).alias("_i", "_f"))
    part = lambda n, missing: F.coalesce(F.col(f"_f.{n}").cast("string"), F.lit(missing))
    rows = rows.select(study, F.struct("_p", "_i").alias("_at"), F.concat_ws("|", part("location", "?"), part("signal_on_this_sequence", ""), part("size_mm", "")).alias("_v"))
    kept = first_distinct(rows, study, "_v", "_at", most).groupBy(study).agg(F.array_sort(F.collect_list(F.struct("place", "_v"))).alias("_k"))
    listed = F.coalesce(F.col("_k._v"), F.array().cast("array<string>"))
    return counts.join(kept, study, "left").select(study, "total_series", "pathology_detected", "disagreements", (F.col("disagreements") > 0).alias("needs_review"), listed.alias("all_findings"))


def consensus(annotations: DataFrame, key: str, sequence: str, found: str, grade: str, tier: str | None = None) -> DataFrame:
    """One row per series: type, agreement, finding by any vote, votes that agree, grade, confidence, escalation, tiers."""
    votes = majority(annotations, key, sequence)
    cells = annotations.groupBy(key).agg(
        F.coalesce(F.bool_or(found), F.lit(False)).alias("found"),
        F.count_if(F.coalesce(F.col(found), F.lit(False))).alias("positive"),
        F.count("*").alias("models_total"),
        grade_mean(F.col(grade)).alias("quality_grade"),
        *([F.sort_array(F.collect_set(tier)).alias("tiers_used"), F.bool_or(F.col(tier) == "premium").alias("premium_used")] if tier else []),
    )
    out = votes.join(cells, key)
    args = F.col("agreement"), F.col("positive"), F.col("models_total")
    agree = F.when(F.col("found"), F.col("positive")).otherwise(F.col("models_total") - F.col("positive"))
    disagreements = F.array_compact(F.array(F.when(F.col("agreement") < 1, F.lit("sequence_type")), F.when((F.col("positive") > 0) & (F.col("positive") < F.col("models_total")), F.lit("pathology_found"))))
    return out.withColumns({"models_agreeing": agree, "confidence": confidence(*args), "needs_escalation": escalate(*args), "disagreements": disagreements}).drop("n_votes")


def route(attempts: DataFrame, key: str, order: str, ok: Column, cost: Column) -> DataFrame:
    """Per key the first acceptable attempt in policy order, the misses before it, and the cost of every attempt made."""
    rows = attempts.select(key, F.col(order).alias("_o"), ok.alias("_ok"), cost.alias("_c"))
    winner = rows.groupBy(key).agg(F.min(F.when(F.col("_ok"), F.col("_o"))).alias("winner"))
    made = rows.join(winner, key).where(F.col("winner").isNull() | (F.col("_o") <= F.col("winner")))
    return made.groupBy(key).agg(F.first("winner").alias("winner"), F.count_if(F.col("winner").isNull() | (F.col("_o") < F.col("winner"))).alias("misses"), F.sum("_c").alias("cost"))


def call_cost(calls: DataFrame, prices: DataFrame, model: str, tokens_in: str, tokens_out: str) -> DataFrame:
    """calls with `cost`: prices are per million tokens (model, price_in, price_out); an unknown model costs nothing."""
    p = prices.select(F.col("model").alias("_model"), "price_in", "price_out")
    out = calls.join(F.broadcast(p), calls[model] == p["_model"], "left")  # a price list of a few rows
    cost = (F.col("price_in") * F.col(tokens_in) + F.col("price_out") * F.col(tokens_out)) / 1e6
    return out.withColumn("cost", F.coalesce(cost, F.lit(0.0))).drop("_model", "price_in", "price_out")


def corpus_cost(policy: DataFrame, n_series: float) -> DataFrame:
    """policy (ord, model, hit_rate, cost_per_call) with calls and spend: each model gets what all before it missed."""
    before = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)  # a policy is a handful of rows
    misses = F.transform(F.collect_list("hit_rate").over(before), lambda h: 1 - h)
    left = F.aggregate(misses, F.lit(float(n_series)), lambda a, m: a * m)
    return policy.withColumn("calls", left).withColumn("spend", F.col("calls") * F.col("cost_per_call"))


def plan_estimate(work: DataFrame, study: str, pending: Column, seconds: float, concurrency: int, dollars: float) -> DataFrame:
    """One row: studies, series, pending series, dollars, wall minutes."""
    out = work.agg(F.count_distinct(study).alias("n_studies"), F.count("*").alias("n_series"), F.count_if(pending).alias("n_pending"))
    return out.withColumn("dollars", F.col("n_pending") * dollars).withColumn("minutes", F.ceil(F.col("n_pending") / concurrency) * seconds / 60)
