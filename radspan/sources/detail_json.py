"""Per-series JSON documents to manifest rows: read whole, parsed once, columns pruned from the struct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.functions.scoring import letter, tier
from radspan.functions.text import plane

SCHEMA = """series struct<uid:string,number:long,description:string,modality:string,sop_class:string,sop_class_uid:string,file_count:long,has_pixels:boolean,source_subdir:string>,
sequence_classification struct<sequence_type:string,confidence:string,reasoning:array<string>,parameters:struct<TR_ms:double,TE_ms:double,TI_ms:double,flip_angle_deg:double,b_value:double>>,
sequence_params struct<tr:double,te:double,ti:double,fa:double,b:double,field_strength:double>,
volume_stats struct<volume_shape:array<long>,spacing_mm:array<double>,fov_mm:array<double>,volume_snr_estimate:double,volume_cnr:double,volume_entropy:double,quality_grade:string,quality_score:double>,
quality_analysis struct<quality_grade:string,quality_score:double>,
advanced_quality struct<ml_training_score:struct<score:double,grade:string,commercial_tier:string>>,
file_paths array<string>, series_uid string, series_number long, series_description string, uid string, number long, description string, modality string, sop_class string, sop_class_uid string, file_count long, has_pixels boolean, source_subdir string, _bad string"""
# fixed values: places of the identity in the nested document and the keys of a flat one that fill them
HOISTED = {"uid": ["series_uid", "uid"], "number": ["series_number", "number"], "description": ["series_description", "description"], "modality": ["modality"], "sop_class": ["sop_class"], "sop_class_uid": ["sop_class_uid"], "file_count": ["file_count"], "has_pixels": ["has_pixels"], "source_subdir": ["source_subdir"]}


def read(spark: SparkSession, root: str) -> DataFrame:
    """path and raw text of every *.json below root."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def arriving(spark: SparkSession, root: str) -> DataFrame:
    """The same rows as a stream of the files that arrive; manifest() and problems() take it as it is."""
    rows = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def parse(raw: DataFrame) -> DataFrame:
    """path, raw, d: the document; anything but a JSON object gives null. Flat documents get a series struct."""
    d = F.when(F.ltrim("raw").startswith("{"), F.from_json("raw", SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    rows = raw.withColumn("d", d)
    nested = F.struct(*[F.coalesce(F.col(f"d.series.{k}"), *[F.col(f"d.{x}") for x in flat]).alias(k) for k, flat in HOISTED.items()])
    return rows.withColumn("series", F.when(F.col("d").isNotNull(), nested))


def problems(raw: DataFrame) -> DataFrame:
    """path, error of documents that are no usable series."""
    rows = parse(raw)
    error = F.when(F.col("d").isNull(), "not an object").when(F.col("d._bad").isNotNull(), "malformed").when(F.coalesce(F.col("series.uid"), F.lit("")) == "", "no series uid")
    return rows.select("path", error.alias("error")).where("error is not null")


def manifest(raw: DataFrame) -> DataFrame:
    """One row per series document with a uid."""
    rows = parse(raw).where((F.coalesce(F.col("series.uid"), F.lit("")) != "") & F.col("d._bad").isNull())
    p, q, score = "d.sequence_classification.parameters", "d.sequence_params", F.coalesce(F.col("d.quality_analysis.quality_score"), F.col("d.volume_stats.quality_score"))
    parts = F.split("path", "/")
    ml = F.col("d.advanced_quality.ml_training_score.score")
    return rows.select(
        F.element_at(parts, F.when(F.size(parts) >= 3, -3).otherwise(-2)).alias("study_id"),
        F.col("series.uid").alias("series_uid"),
        F.col("series.number").alias("series_number"),
        F.col("series.description").alias("series_description"),
        F.col("d.sequence_classification.sequence_type").alias("sequence_type"),
        F.coalesce("d.sequence_classification.confidence", F.lit("unknown")).alias("sequence_confidence"),
        F.col("series.modality").alias("modality"),
        F.col("series.file_count").alias("file_count"),
        *[F.coalesce(F.col(f"{p}.{a}"), F.col(f"{q}.{b}")).alias(n) for n, a, b in (("tr_ms", "TR_ms", "tr"), ("te_ms", "TE_ms", "te"), ("ti_ms", "TI_ms", "ti"), ("fa_deg", "flip_angle_deg", "fa"), ("b_value", "b_value", "b"))],
        F.col(f"{q}.field_strength").alias("field_strength_T"),
        plane(F.col("series.description")).alias("plane"),
        *[F.col(f"d.volume_stats.{c}").alias(c) for c in ("volume_shape", "spacing_mm", "fov_mm")],
        F.col("d.volume_stats.volume_snr_estimate").alias("volume_snr"),
        F.col("d.volume_stats.volume_cnr").alias("volume_cnr"),
        F.col("d.volume_stats.volume_entropy").alias("volume_entropy"),
        F.coalesce("d.quality_analysis.quality_grade", "d.volume_stats.quality_grade", F.when(score.isNotNull(), letter(score))).alias("quality_grade"),
        score.alias("quality_score"),
        ml.alias("ml_score"),
        F.coalesce("d.advanced_quality.ml_training_score.grade", F.when(ml.isNotNull(), letter(ml))).alias("ml_grade"),
        F.coalesce("d.advanced_quality.ml_training_score.commercial_tier", F.when(ml.isNotNull(), tier(ml))).alias("commercial_tier"),
        F.col("path").alias("detail_path"),
        F.sha2("raw", 256).alias("sha256"),
    )
