"""Cohorts, roll-ups and splits over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from radspan.operators import cohorts, manifest, splits
from radspan.plans.proxies import SERIES, STUDIES, series, studies, table

WORDS = {"has_economy": ["econ"], "has_promo": ["promo"], "has_large": ["large", "medium"]}


def cohort_grade_seq_vendor(spark, sf):
    rows = series(spark, sf).join(studies(spark, sf).select("study_id", "vendor"), "study_id")
    rows = cohorts.single_field(cohorts.single_vendor(cohorts.sequence_contains(cohorts.grade_at_least(rows, "B"), "promo"), "building"), 0.04, tolerance=0.0151)
    return rows.select("study_id", "series_key", "sequence_type", "quality_grade", "vendor", "score")


def cohort_swan_like(spark, sf):
    return cohorts.sequence_contains(table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("sequence_type")), "small|econ")


def cohort_complete_protocol_study(spark, sf):
    rows = manifest.study_rollup(series(spark, sf), WORDS, score="score")
    rows = cohorts.complete_protocol_studies(rows, ["Promo", "econ"])
    return rows.select("study_id", F.array_join("sequences_present", "|").alias("sequences"))


def cohort_complete_protocol_series(spark, sf):
    return cohorts.complete_protocol_series(series(spark, sf), ["promo", "small"]).select("study_id", "series_key", "sequence_type", "file_count")


def cohort_two_sequences(spark, sf):
    return cohorts.with_both(series(spark, sf), "PROMO", "ECONOMY").select("study_id", "series_key", "sequence_type")


def cohort_exact_filters(spark, sf):
    return cohorts.exact(series(spark, sf), "promo", ["a", "C"]).select("study_id", "series_key", "quality_grade", "sequence_type")


def cohort_date_and_grade(spark, sf):
    chosen = cohorts.since(studies(spark, sf), "1999-01-01")
    rows = cohorts.grade_at_least(series(spark, sf), "A")
    return rows.join(chosen.select("study_id"), "study_id", "left_semi").select("study_id", "series_key", "score")


def study_rollup(spark, sf):
    out = manifest.study_rollup(series(spark, sf), WORDS, score="score")
    return out.withColumn("sequences_present", F.array_join("sequences_present", "|")).withColumn("mean_ml_score", F.round("mean_ml_score", 6))


def study_manifest(spark, sf):
    notes = table(spark, sf, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("study_id"), F.when(F.col("l_linenumber") < 5, F.col("l_quantity") / 64).alias("confidence"), (F.col("l_returnflag") == "R").alias("needs_escalation"), (F.col("l_linestatus") == "O").alias("premium_used"))
    k, third = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    path = F.concat(k, F.lit("/"), F.when(third == 0, F.concat(k, F.lit(".slices.tar"))).when(third == 1, "other.slices.tar").otherwise(F.concat(k, F.lit(".slices.tar.part"))))
    listing = table(spark, sf, "orders").select(path.alias("path"), (F.col("o_orderkey") * 1000).alias("bytes"))
    out = manifest.study_manifest(series(spark, sf), notes, listing, WORDS, score="score")
    figures = ("mean_ml_score", "total_size_mb", "confidence_mean", "confidence_min", "confidence_pct_low", "confidence_pct_premium_used")
    return out.withColumns({c: F.round(c, 6) for c in figures} | {"sequences_present": F.array_join("sequences_present", "|")})


def confidence_rollup(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.pmod("event_id", F.lit(1000)).cast("double").alias("m"), (F.col("event_type") == "error").alias("needs_escalation"), (F.col("event_type") == "purchase").alias("premium_used"))
    rows = rows.withColumn("confidence", F.when(F.col("m") > 50, F.col("m") / 1000))
    out = manifest.confidence_rollup(rows, ["user_id"])
    return out.select("user_id", "n_series", *[F.round(c, 8).alias(c) for c in ("mean_confidence", "min_confidence", "pct_low_confidence", "pct_premium_used")], "n_needs_escalation")


def dataset_rollup(spark, sf):
    return manifest.dataset_rollup(series(spark, sf), validated=F.col("field_strength_T") >= 0.05)


def study_grade(spark, sf):
    out = manifest.study_grade(series(spark, sf))
    return out.select("study_id", F.round("avg_score", 6).alias("avg_score"), "worst_score", "best_score", "n_series", "n_a", "n_b", "n_c", "n_d", "n_f", F.round("score", 6).alias("score"), "grade")


def series_view(spark, sf):
    return manifest.series_with_study(series(spark, sf).select("study_id", "series_key", "score"), studies(spark, sf).select("study_id", "vendor", "price"))


def split_assign(spark, sf):
    return splits.assign(studies(spark, sf), stratify=["dominant_grade", "vendor"]).select("study_id", "split", "vendor", "dominant_grade")


def split_summary(spark, sf):
    return splits.summary(split_assign(spark, sf), ["dominant_grade", "vendor"])


def split_series_propagate(spark, sf):
    return splits.propagate(series(spark, sf).select("study_id", "series_key"), split_assign(spark, sf)).groupBy("study_id", "split").agg(F.count("*").alias("n"))


def stratified_sample(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return splits.stratified_sample(rows, "c_mktsegment", 100, 7, "c_custkey")


def seeded_sample(spark, sf):
    return splits.seeded_sample(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 100, 7, "o_orderkey")


def hash_bucket_split(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return cohorts.split_member(rows, "train", "l_partkey").groupBy("l_partkey").agg(F.count("*").alias("n"))


def pending_work(spark, sf):
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return cohorts.pending(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), done, "o_orderkey", F.col("o_orderstatus") == "P")


_SPLIT = f"""{STUDIES}, labelled AS (SELECT *, coalesce(dominant_grade, '__null__') || '|' || coalesce(vendor, '__null__') AS s0 FROM studies),
counted AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY s0) < 2 THEN '__other__' ELSE s0 END AS s FROM labelled),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY sha256('42:' || CAST(study_id AS VARCHAR)), study_id) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY s) AS spot FROM counted),
placed AS (SELECT *, row_number() OVER (ORDER BY spot, sha256('42:' || CAST(study_id AS VARCHAR)), study_id) AS place, count(*) OVER () AS n FROM ranked),
tested AS (SELECT *, least(greatest(1, round_even(n * 0.1::DOUBLE, 0)), n - 1) AS t FROM placed),
splits AS (SELECT study_id, vendor, dominant_grade, CASE WHEN place <= t THEN 'test' WHEN place <= t + least(greatest(1, round_even((n - t) * (0.1::DOUBLE / (0.8::DOUBLE + 0.1::DOUBLE)), 0)), n - t - 1) THEN 'val' ELSE 'train' END AS split FROM tested)"""
_FLAG = "coalesce(bool_or(regexp_matches(lower(sequence_type), '{}')), false)"

QUERIES = {f.__name__: f for f in (cohort_grade_seq_vendor, cohort_swan_like, cohort_complete_protocol_study, cohort_complete_protocol_series, cohort_two_sequences, cohort_exact_filters, cohort_date_and_grade, study_rollup, study_manifest, confidence_rollup, dataset_rollup, study_grade, series_view, split_assign, split_summary, split_series_propagate, stratified_sample, seeded_sample, hash_bucket_split, pending_work)}
ORACLE = {
    "cohort_grade_seq_vendor": f"WITH {SERIES}, {STUDIES} SELECT study_id, series_key, sequence_type, quality_grade, vendor, score FROM series JOIN studies USING (study_id) WHERE quality_grade IN ('A', 'B') AND lower(sequence_type) LIKE '%promo%' AND lower(vendor) = 'building' AND abs(field_strength_T - 0.04::DOUBLE) <= 0.0151::DOUBLE",
    "cohort_swan_like": "SELECT p_partkey, p_type AS sequence_type FROM part WHERE regexp_matches(lower(p_type), 'small|econ')",
    "cohort_complete_protocol_study": f"WITH {SERIES} SELECT study_id, array_to_string(list_sort(list_distinct(list(sequence_type))), '|') AS sequences FROM series GROUP BY study_id HAVING bool_or(lower(sequence_type) LIKE '%promo%') AND bool_or(lower(sequence_type) LIKE '%econ%')",
    "cohort_complete_protocol_series": f"WITH {SERIES} SELECT study_id, series_key, sequence_type, file_count FROM series WHERE study_id IN (SELECT study_id FROM series WHERE lower(sequence_type) LIKE '%promo%') AND study_id IN (SELECT study_id FROM series WHERE lower(sequence_type) LIKE '%small%')",
    "cohort_two_sequences": f"WITH {SERIES} SELECT study_id, series_key, sequence_type FROM series WHERE study_id IN (SELECT study_id FROM series WHERE sequence_type = 'PROMO' INTERSECT SELECT study_id FROM series WHERE sequence_type = 'ECONOMY')",
    "cohort_exact_filters": f"WITH {SERIES} SELECT study_id, series_key, quality_grade, sequence_type FROM series WHERE upper(sequence_type) = 'PROMO' AND upper(quality_grade) IN ('A', 'C')",
    "cohort_date_and_grade": f"WITH {SERIES}, {STUDIES} SELECT study_id, series_key, score FROM series WHERE quality_grade = 'A' AND study_id IN (SELECT study_id FROM studies WHERE study_date >= DATE '1999-01-01')",
    "study_rollup": f"""WITH {SERIES}, g AS (SELECT study_id, quality_grade, row_number() OVER (PARTITION BY study_id ORDER BY count(*) DESC, quality_grade) AS r FROM series WHERE quality_grade IS NOT NULL GROUP BY study_id, quality_grade)
SELECT s.study_id, s.n_series, s.sequences_present, s.total_files, g.quality_grade AS dominant_grade, s.mean_ml_score, s.has_economy, s.has_promo, s.has_large FROM (
SELECT study_id, count(*) AS n_series, array_to_string(list_sort(list_distinct(list(sequence_type))), '|') AS sequences_present, CAST(sum(file_count) AS BIGINT) AS total_files, round(avg(score), 6) AS mean_ml_score, {_FLAG.format('econ')} AS has_economy, {_FLAG.format('promo')} AS has_promo, {_FLAG.format('large|medium')} AS has_large FROM series GROUP BY study_id) s LEFT JOIN g ON s.study_id = g.study_id AND g.r = 1""",
    "confidence_rollup": """WITH e AS (SELECT *, CASE WHEN event_id % 1000 > 50 THEN (event_id % 1000)::DOUBLE / 1000 END AS c FROM events)
SELECT user_id, count(*) AS n_series, round(avg(c), 8) AS mean_confidence, round(min(c), 8) AS min_confidence, round(avg((c < 0.6::DOUBLE)::INT), 8) AS pct_low_confidence, round(avg((event_type = 'purchase')::INT), 8) AS pct_premium_used, count_if(event_type = 'error')::BIGINT AS n_needs_escalation FROM e WHERE c IS NOT NULL GROUP BY user_id""",
    "dataset_rollup": f"""WITH {SERIES}, a AS (SELECT sequence_type, quality_grade, file_count, field_strength_T >= 0.05::DOUBLE AS v FROM series)
SELECT 'sequence' AS kind, sequence_type AS name, count(*) AS n, count_if(v)::BIGINT AS n_validated, sum(file_count)::BIGINT AS n_files FROM a GROUP BY sequence_type UNION ALL
SELECT 'grade', quality_grade, count(*), count_if(v)::BIGINT, sum(file_count)::BIGINT FROM a GROUP BY quality_grade UNION ALL
SELECT 'all', '', count(*), count_if(v)::BIGINT, sum(file_count)::BIGINT FROM a""",
    "study_grade": f"""WITH {SERIES}, a AS (SELECT study_id, avg(score) AS av, min(score) AS lo, max(score) AS hi, count(*) AS n_series, {', '.join(f"count_if(quality_grade = '{g}')::BIGINT AS n_{g.lower()}" for g in 'ABCDF')} FROM series GROUP BY study_id), b AS (SELECT *, av * 0.7::DOUBLE + lo * 0.3::DOUBLE AS sc FROM a)
SELECT study_id, round(av, 6) AS avg_score, lo AS worst_score, hi AS best_score, n_series, n_a, n_b, n_c, n_d, n_f, round(sc, 6) AS score, CASE WHEN sc >= 80 THEN 'A' WHEN sc >= 65 THEN 'B' WHEN sc >= 50 THEN 'C' WHEN sc >= 35 THEN 'D' ELSE 'F' END AS grade FROM b""",
    "series_view": f"WITH {SERIES}, {STUDIES} SELECT s.study_id, s.series_key, s.score, t.vendor AS study_vendor, t.price AS study_price FROM series s LEFT JOIN studies t ON s.study_id = t.study_id",
    "split_assign": f"WITH {_SPLIT} SELECT study_id, split, vendor, dominant_grade FROM splits",
    "split_summary": f"WITH {_SPLIT} SELECT split, 'all' AS kind, '' AS name, count(*) AS n FROM splits GROUP BY split UNION ALL SELECT split, 'dominant_grade', dominant_grade, count(*) FROM splits GROUP BY ALL UNION ALL SELECT split, 'vendor', vendor, count(*) FROM splits GROUP BY ALL",
    "split_series_propagate": f"WITH {SERIES}, {_SPLIT} SELECT series.study_id, split, count(*) AS n FROM series LEFT JOIN splits ON series.study_id = splits.study_id GROUP BY ALL",
    "stratified_sample": "WITH a AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('7:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS r, count(*) OVER (PARTITION BY c_mktsegment) AS n, count(*) OVER () AS t FROM customer) SELECT c_custkey, c_mktsegment FROM a WHERE r <= greatest(1, least(n, floor(n * 100 / t::DOUBLE + 0.5)))",
    "seeded_sample": "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY sha256('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100",
    "hash_bucket_split": "SELECT l_partkey, count(*) AS n FROM lineitem WHERE CAST('0x' || substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 >= 2 GROUP BY l_partkey",
    "pending_work": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND o_orderstatus <> 'P'",
}
ORACLE["study_manifest"] = f"""SELECT u.*, CASE WHEN u.study_id % 3 = 0 THEN round(u.study_id * 1000 / 1048576::DOUBLE, 6) END AS total_size_mb, CASE WHEN u.study_id % 3 = 0 THEN u.study_id || '/' || u.study_id || '.slices.tar' END AS tar_shard_path, coalesce(c.n, 0) AS confidence_n_series,
coalesce(c.m, 0.0) AS confidence_mean, coalesce(c.lo, 0.0) AS confidence_min, coalesce(c.low, 0.0) AS confidence_pct_low, coalesce(c.esc, 0) AS confidence_n_needs_escalation, coalesce(c.prem, 0.0) AS confidence_pct_premium_used
FROM ({ORACLE["study_rollup"]}) u LEFT JOIN (SELECT l_orderkey, count(*) AS n, round(avg(q), 6) AS m, round(min(q), 6) AS lo, round(avg((q < 0.6::DOUBLE)::INT), 6) AS low, count_if(l_returnflag = 'R')::BIGINT AS esc, round(avg((l_linestatus = 'O')::INT), 6) AS prem
FROM (SELECT *, l_quantity::DOUBLE / 64 AS q FROM lineitem WHERE l_quantity > 10 AND l_linenumber < 5) GROUP BY 1) c ON c.l_orderkey = u.study_id"""
