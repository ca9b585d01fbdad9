"""Exports, training views and summaries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from radspan.functions import exports
from radspan.operators import datasets, splits
from radspan.plans.cohort_queries import _SPLIT
from radspan.plans.proxies import SERIES, series, studies, table


def bids_sidecar(spark, sf):
    k = F.col("p_partkey")
    seq = F.when(k % 3 == 0, "FLAIR").when(k % 3 == 1, "DWI").otherwise("T1-weighted")
    doc = exports.sidecar(seq, F.col("p_name"), (k * 7).cast("string"), F.when(k % 5 == 0, "x").otherwise((k % 90).cast("string")), F.lit("2000"), F.col("p_size"), k % 1000, F.lit(None).cast("string"), F.lit("1.5"), F.col("p_brand"), F.lit(""), F.lit("20240131"), F.array(F.col("p_name")))
    rows = table(spark, sf, "part").select("p_partkey", doc.alias("d"))
    get = lambda p: F.get_json_object("d", f"$.{p}")
    return rows.select("p_partkey", *[F.round(get(p).cast("double"), 6).alias(p.lower()) for p in ("RepetitionTime", "EchoTime", "InversionTime", "DiffusionBValue", "MagneticFieldStrength")], get("AcquisitionTime").alias("day"), get("ManufacturerModelName").alias("model"))


def open_projection(spark, sf):
    k = F.col("c_custkey")
    info = F.create_map(F.lit("patient_name"), F.col("c_name"), F.lit("patient_sex"), F.when(k % 3 == 0, "m").otherwise("?"), F.lit("patient_birth_date"), F.concat((k % 90 + 1930).cast("string"), F.lit("0101")), F.lit("study_date"), F.when(k % 5 > 0, "20200101").otherwise("x"), F.lit("manufacturer"), F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(k, F.array_join(F.transform(F.array_sort(F.map_entries(exports.open_projection(info))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("open"))


def chunk_shapes(spark, sf):
    n = F.col("p_size").cast("long")
    rows = table(spark, sf, "part").select("p_partkey", n.alias("n"), exports.chunk_slices(n * 3, n * 20, n * 16).alias("chunk"))
    return rows.select("p_partkey", "chunk", exports.shard_slices(F.col("n") * 3, F.col("chunk"), 64).alias("shard"), F.array_join(exports.picked_slices(F.col("n"), 3).cast("array<string>"), "|").alias("picked"))


def shift_any(spark, sf):
    k = F.col("o_orderkey")
    v = F.when(k % 5 == 0, "101500.5").when(k % 5 == 1, "20241340").when(k % 5 == 2, F.date_format("o_orderdate", "yyyyMMdd")).when(k % 5 == 3, F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("101500.5"))).otherwise("")
    return table(spark, sf, "orders").select(k, exports.shift_any(v, -40).alias("v"))


def dataset_config(spark, sf):
    assigned = splits.assign(studies(spark, sf), stratify=["dominant_grade", "vendor"])
    return datasets.config(series(spark, sf), "grade_a", assigned, "validation").select("study_id", "series_key", "split")


def loader_rows(spark, sf):
    rows = datasets.loader_rows(series(spark, sf), F.col("series_key"), exports.grade_label(F.col("quality_grade")), {"PROMO": ["load", "noise"], "SMALL": ["load", "flip"]}, ["load"])
    return rows.groupBy("label", F.array_join("transforms", "|").alias("transforms")).agg(F.count("*").alias("n"))


def segmentation_summary(spark, sf):
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") % 3 == 0).alias("has_mask"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("volume"))
    return datasets.segmentation_summary(rows, ["has_mask", "has_lesion"], ["volume", "lesion"]).withColumn("mean_volume", F.round("mean_volume", 4))


def preferred_file(spark, sf):
    return datasets.preferred_file(table(spark, sf, "part").select("p_brand", "p_name", "p_type"), "p_brand", "p_name", "p_type", ["PROMO", "SMALL"])


def backfilled(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_type")).alias("kind"))
    return datasets.backfilled(rows, {"kind": F.lit("unknown"), "version": F.lit("1")})


def size_categories(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")).select("o_orderstatus", exports.size_category(F.col("n")).alias("size"))


QUERIES = {f.__name__: f for f in (bids_sidecar, open_projection, chunk_shapes, shift_any, dataset_config, loader_rows, segmentation_summary, preferred_file, backfilled, size_categories)}
_NN = "greatest(floor(524288 / (n * 20 * n * 16)::DOUBLE), 1)"
ORACLE = {
    "bids_sidecar": "SELECT p_partkey, round(p_partkey * 7 / 1000::DOUBLE, 6) AS repetitiontime, CASE WHEN p_partkey % 5 > 0 THEN round(p_partkey % 90 / 1000::DOUBLE, 6) END AS echotime, CASE WHEN p_partkey % 3 = 0 THEN 2.0::DOUBLE END AS inversiontime, CASE WHEN p_partkey % 3 = 1 THEN (p_partkey % 1000)::DOUBLE END AS diffusionbvalue, 1.5::DOUBLE AS magneticfieldstrength, '2024-01-31' AS day, NULL::VARCHAR AS model FROM part",
    "open_projection": "WITH a AS (SELECT *, 2020 - (c_custkey % 90 + 1930) AS age FROM customer) SELECT c_custkey, concat_ws('|', 'manufacturer=' || c_mktsegment, CASE WHEN c_custkey % 5 > 0 AND age BETWEEN 0 AND 120 THEN 'patient_age_bracket=' || CAST(age // 10 * 10 AS VARCHAR) || 's' END, CASE WHEN c_custkey % 3 = 0 THEN 'patient_sex=M' END, CASE WHEN c_custkey % 5 > 0 THEN 'study_date_year=2020' END) AS open FROM a",
    "chunk_shapes": f"WITH a AS (SELECT p_partkey, p_size::BIGINT AS n FROM part), b AS (SELECT *, CAST(least({_NN}, n * 3) AS BIGINT) AS chunk FROM a) SELECT p_partkey, chunk, CAST(greatest(least(n * 3, chunk * greatest(64 // chunk, 1)), chunk) AS BIGINT) AS shard, CASE WHEN n > 1 THEN concat_ws('|', n // 8, CAST(floor(n // 8 + (least(n - n // 8, n - 1) - n // 8) / 2::DOUBLE) AS INT), least(n - n // 8, n - 1)) ELSE '0' END AS picked FROM b",
    "shift_any": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '101500.5' WHEN 1 THEN '' WHEN 2 THEN strftime(CAST(o_orderdate AS DATE) - 40, '%Y%m%d') WHEN 3 THEN strftime(CAST(o_orderdate AS DATE) - 40, '%Y%m%d') || '101500.5' ELSE '' END AS v FROM orders",
    "dataset_config": f"WITH {SERIES}, {_SPLIT} SELECT series.study_id, series_key, split FROM series JOIN splits ON series.study_id = splits.study_id WHERE quality_grade = 'A' AND split = 'val'",
    "loader_rows": f"WITH {SERIES} SELECT CASE quality_grade WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 ELSE 0 END AS label, CASE WHEN upper(sequence_type) LIKE '%PROMO%' THEN 'load|noise' WHEN upper(sequence_type) LIKE '%SMALL%' THEN 'load|flip' ELSE 'load' END AS transforms, count(*) AS n FROM series GROUP BY 1, 2",
    "segmentation_summary": "SELECT count(*) AS n_studies, count_if(o_orderkey % 3 = 0)::BIGINT AS n_has_mask, 0::BIGINT AS n_has_lesion, round(avg(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END), 4) AS mean_volume, 0.0::DOUBLE AS mean_lesion FROM orders",
    "preferred_file": "SELECT p_brand, p_name, p_type FROM (SELECT p_brand, p_name, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY CASE p_type WHEN 'PROMO' THEN 0 WHEN 'SMALL' THEN 1 ELSE 2 END, p_name) AS r FROM part) WHERE r = 1",
    "backfilled": "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_type ELSE 'unknown' END AS kind, '1' AS version FROM part",
    "size_categories": "SELECT o_orderstatus, CASE WHEN count(*) > 100000 THEN '100K<n<1M' WHEN count(*) > 10000 THEN '10K<n<100K' WHEN count(*) > 1000 THEN '1K<n<10K' ELSE 'n<1K' END AS size FROM orders GROUP BY 1",
}
