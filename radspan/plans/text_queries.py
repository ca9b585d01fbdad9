"""Names, labels, sequence types and scores over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.functions import classify, scoring, text
from radspan.plans.proxies import table


def plane_label(spark, sf):
    rows = table(spark, sf, "part")
    return rows.select("p_partkey", text.plane(F.col("p_name")).alias("plane"), text.acquisition(F.concat("p_name", F.lit(" AxT1 "), "p_type")).alias("acq"))


def bids_name(spark, sf):
    """Run counters: the first of its kind has none."""
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", text.acquisition(F.when(F.col("p_size") % 3 == 0, "SAG T1").otherwise("T2")).alias("acq"))
    run = F.row_number().over(Window.partitionBy("p_brand", "p_type", "acq").orderBy("p_partkey"))
    return rows.withColumn("_n", run).select("p_partkey", text.bids_name(F.col("p_brand"), None, F.col("acq"), F.when(F.col("_n") > 1, F.col("_n")), F.lower("p_type")).alias("path"))


def safe_names(spark, sf):
    rows = table(spark, sf, "pages")
    return rows.select("page_id", text.safe_name(F.col("url"), unicode=False).alias("safe"), text.file_label(F.col("url")).alias("label"), text.slug(F.col("url")).alias("slug"))


def slugify_unique(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))
    n = F.row_number().over(Window.partitionBy("slug").orderBy("p_partkey")) - 1
    return rows.withColumn("_n", n).select("p_partkey", F.when(F.col("_n") > 0, F.concat_ws("-", "slug", F.col("_n").cast("string"))).otherwise(F.col("slug")).alias("name"))


def _timed(spark, sf):
    k = F.col("p_partkey")
    words = F.array(*map(F.lit, ["Ax T2 FLAIR", "3D Ax T2 Cube", "SE T1_3D", "DWI b1000", "eADC", "WIP SWAN", "B-FFE", "none", "", "PD W"]))
    return table(spark, sf, "part").select(
        k,
        F.concat(F.element_at(words, (k % 10 + 1).cast("int")), F.lit(" "), F.when(k % 4 == 0, F.col("p_name")).otherwise("")).alias("name"),
        F.when(k % 3 > 0, (k * 37 % 5000).cast("double")).alias("tr"),
        F.when(k % 5 > 0, (k * 13 % 120).cast("double")).alias("te"),
        F.when(k % 7 > 2, (k * 91 % 2500).cast("double")).alias("ti"),
        (k % 90).cast("double").alias("fa"),
        F.when(k % 2 == 0, (k % 3 * 500).cast("double")).alias("b"),
    )


_TIMED = """timed AS (SELECT p_partkey, list_value('Ax T2 FLAIR', '3D Ax T2 Cube', 'SE T1_3D', 'DWI b1000', 'eADC', 'WIP SWAN', 'B-FFE', 'none', '', 'PD W')[p_partkey % 10 + 1] || ' ' || CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE '' END AS name,
CASE WHEN p_partkey % 3 > 0 THEN (p_partkey * 37 % 5000)::DOUBLE END AS tr, CASE WHEN p_partkey % 5 > 0 THEN (p_partkey * 13 % 120)::DOUBLE END AS te, CASE WHEN p_partkey % 7 > 2 THEN (p_partkey * 91 % 2500)::DOUBLE END AS ti, (p_partkey % 90)::DOUBLE AS fa, CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 3 * 500)::DOUBLE END AS b FROM part)"""


def sequence_classify(spark, sf):
    out = classify.with_sequence(_timed(spark, sf), "name", "tr", "te", "ti", "fa", "b")
    return out.select("p_partkey", "sequence_type", "confidence", F.col("parameters.TR_ms").alias("tr_ms"))


def _classify_sql() -> str:
    norm = r"regexp_replace(regexp_replace(upper(regexp_replace(name, '^\s+|\s+$', '', 'g')), '[_\-/\\]+', ' ', 'g'), '\s+', ' ', 'g')"
    steps = [f"n0 AS (SELECT *, {norm} AS d FROM timed)"]
    for i, p in enumerate(classify.PREFIXES):
        steps.append(f"n{i + 1} AS (SELECT * REPLACE (CASE WHEN starts_with(d, '{p}') THEN substr(d, {len(p) + 1}) ELSE d END AS d) FROM n{i})")
    cases = "CASE " + " ".join(f"WHEN regexp_matches(d, '{p}') THEN '{t}'" for p, t in classify.PATTERNS) + " END"
    steps.append(f"named AS (SELECT *, {cases} AS nm FROM n{len(classify.PREFIXES)})")
    kind, sure = classify.classified_sql("nm")
    return f"WITH {_TIMED}, {', '.join(steps)} SELECT p_partkey, {kind} AS sequence_type, {sure} AS confidence, tr AS tr_ms FROM named"


def age_brackets(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.age_bracket(F.year("o_orderdate") - (F.col("o_orderkey") % 130).cast("int"), 2001).alias("bracket"))


def study_id_parse(spark, sf):
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("sub-"), "c_custkey", F.lit("_ses-"), "c_nationkey")).otherwise(F.col("c_name"))
    sub, ses = text.study_parts(name)
    return table(spark, sf, "customer").select("c_custkey", sub.alias("subject"), ses.alias("session"))


def llm_json_parse(spark, sf):
    """Replies made of event properties: plain, fenced, inside prose, errors, broken."""
    k = F.col("event_id") % 6
    raw = F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```"))).when(k == 2, F.concat(F.lit("I see "), "props", F.lit(" there."))).when(k == 3, F.lit("[error: no reply]")).when(k == 4, F.lit("[1, 2]")).otherwise("{broken")
    return table(spark, sf, "events").select("event_id", F.get_json_object(text.json_object(raw), "$.k").cast("long").alias("k"))


def hedging_flag(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.hedges(F.concat("text", F.when(F.col("doc_id") % 3 == 0, " possibly subtle, may be faint").otherwise(""))).alias("hedges"))


def derivative_flag(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.is_derived(F.concat(F.when(F.col("p_size") % 4 == 0, "dREG ").when(F.col("p_size") % 4 == 1, "COL: ").otherwise(""), "p_name")).alias("derived"))


def _parts():
    q, d = F.col("l_quantity"), F.col("l_discount")
    name = F.when(F.col("l_linenumber") == 1, "Ax DWI").when(F.col("l_linenumber") == 2, "SWAN").when(F.col("l_linenumber") == 3, "DSC perfusion").when(F.col("l_linenumber") == 4, "MRS").otherwise("T1")
    return scoring.series_parts(q / 4, F.when(F.col("l_linenumber") != 5, q / 8), d * 10 - F.lit(0.25), q, F.col("l_extendedprice") / 100, F.col("l_tax") * 80, q * 2, name)


_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]


def grade_series(spark, sf):
    score = scoring.total(_parts())
    return table(spark, sf, "lineitem").select(*_KEYS, F.round(score, 6).alias("score"), scoring.letter(F.round(score, 6)).alias("grade"))


def ml_training_score(spark, sf):
    q = F.col("l_quantity")
    score = scoring.total(scoring.training_parts(q / 3, q, F.col("l_discount"), q * 5, F.col("l_linenumber"), F.col("l_tax") * 12))
    return table(spark, sf, "lineitem").select(*_KEYS, F.round(score, 6).alias("score"), scoring.letter(F.round(score, 6)).alias("grade"), scoring.tier(F.round(score, 6)).alias("tier"))


_GRADE_SQL = f"""WITH a AS (SELECT {', '.join(_KEYS)}, l_quantity AS q, l_discount AS d, l_tax AS t,
CASE l_linenumber WHEN 1 THEN 8.0::DOUBLE WHEN 2 THEN 10.0::DOUBLE WHEN 3 THEN 10.0::DOUBLE WHEN 4 THEN 5.0::DOUBLE ELSE 20.0::DOUBLE END AS ts,
CASE l_linenumber WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 8.0::DOUBLE WHEN 3 THEN 6.0::DOUBLE WHEN 4 THEN 3.0::DOUBLE ELSE 12.0::DOUBLE END AS tc FROM lineitem),
b AS (SELECT *, round(least(q / 4 / ts, 1) * 25 + least(CASE WHEN l_linenumber <> 5 THEN q / 8 ELSE q / 4 END / tc, 1) * 10 + greatest(0, least(d * 10 - 0.25::DOUBLE, 1)) * 20 + least(q / 60, 1) * 15 + least(l_extendedprice / 100 / 500, 1) * 12 + least(t * 80 / 5, 1) * 10 + least(q * 2 / 50, 1) * 8, 6) AS score FROM a)
SELECT {', '.join(_KEYS)}, score, {scoring.cuts_sql('score')} AS grade FROM b"""
_ML_SQL = f"""WITH b AS (SELECT *, round(least(l_quantity / 3 / 15, 1) * 25 + greatest(0, 1 - l_quantity / 50) * 20 + greatest(0, 1 - l_discount / 0.2::DOUBLE) * 15 + least(l_quantity * 5 / 200, 1) * 15 + least(l_linenumber::DOUBLE / 3, 1) * 10 + least(l_tax * 12, 1) * 15, 6) AS score FROM lineitem)
SELECT {', '.join(_KEYS)}, score, {scoring.cuts_sql('score')} AS grade, {scoring.cuts_sql('score', scoring.TIERS, 'exclude')} AS tier FROM b"""

QUERIES = {f.__name__: f for f in (plane_label, bids_name, safe_names, slugify_unique, sequence_classify, age_brackets, study_id_parse, llm_json_parse, hedging_flag, derivative_flag, grade_series, ml_training_score)}
ORACLE = {
    "plane_label": "SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%sag%' THEN 'sagittal' WHEN lower(p_name) LIKE '%cor%' THEN 'coronal' WHEN lower(p_name) LIKE '%ax%' THEN 'axial' END AS plane, CASE WHEN regexp_matches(p_name || ' AxT1 ' || p_type, '(?i)\\bax\\b|\\bax[A-Z0-9]|\\baxial\\b') THEN 'axial' END AS acq FROM part",
    "bids_name": "WITH a AS (SELECT *, CASE WHEN p_size % 3 = 0 THEN 'sagittal' END AS acq FROM part), b AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type, acq ORDER BY p_partkey) AS n FROM a) SELECT p_partkey, 'sub-' || regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') || coalesce('_acq-' || acq, '') || CASE WHEN n > 1 THEN '_run-' || n ELSE '' END || '_' || lower(p_type) || '.nii.gz' AS path FROM b",
    "safe_names": "SELECT page_id, regexp_replace(url, '[^\\w\\-]', '_', 'g') AS safe, substr(regexp_replace(trim(regexp_replace(url, '[^\\w\\s\\-.]', '', 'g')), '\\s+', '_', 'g'), 1, 50) AS label, regexp_replace(regexp_replace(lower(url), '[^a-z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g') AS slug FROM pages",
    "slugify_unique": "WITH a AS (SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g') AS s FROM part), b AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p_partkey) - 1 AS n FROM a) SELECT p_partkey, CASE WHEN n > 0 THEN s || '-' || n ELSE s END AS name FROM b",
    "sequence_classify": _classify_sql(),
    "age_brackets": "WITH a AS (SELECT o_orderkey, 2001 - (year(o_orderdate) - o_orderkey % 130) AS age FROM orders) SELECT o_orderkey, CASE WHEN age BETWEEN 0 AND 120 THEN CAST(age // 10 * 10 AS VARCHAR) || 's' ELSE 'n/a' END AS bracket FROM a",
    "study_id_parse": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS subject, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '01' END AS session FROM customer",
    "llm_json_parse": "SELECT event_id, CASE WHEN event_id % 6 <= 2 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events",
    "hedging_flag": f"SELECT doc_id, len(regexp_extract_all(text || CASE WHEN doc_id % 3 = 0 THEN ' possibly subtle, may be faint' ELSE '' END, '{text.DOUBT}')) >= 2 AS hedges FROM documents",
    "derivative_flag": f"SELECT p_partkey, regexp_matches(CASE p_size % 4 WHEN 0 THEN 'dREG ' WHEN 1 THEN 'COL: ' ELSE '' END || p_name, '{text.DERIVED}') AS derived FROM part",
    "grade_series": _GRADE_SQL,
    "ml_training_score": _ML_SQL,
}
