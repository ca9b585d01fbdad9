"""Run totals, subject numbers, annotation summaries and small rules over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from radspan.functions import briefs, exports, text
from radspan.operators import consensus, privacy, summaries
from radspan.plans.privacy_queries import _CONF, _FULL, _TAGS, _tagged, _votes
from radspan.plans.proxies import table


def subject_numbers(spark, sf):
    return summaries.subject_numbers(table(spark, sf, "customer"), "c_name")


def annotation_summary(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id")
    values = {"grade": F.element_at(F.array(*map(F.lit, "ABCDF")), (k % 5 + 1).cast("int")), "tier": F.when(k % 3 > 0, F.col("event_type"))}
    tags = {"targets": F.array(F.col("event_type"), F.when(k % 2 == 0, F.concat(F.lit("t"), (k % 4).cast("string"))))}
    out = summaries.annotation_summary(e, "user_id", values, tags, {"n_findings": k % 7 == 0})
    counted = lambda c: F.array_join(F.transform(c, lambda p: F.concat_ws(":", p["value"], p["n"])), "|")
    return out.select("user_id", "n", "n_findings", counted(F.col("grade_counts")).alias("grades"), "grade_mode", counted(F.col("tier_counts")).alias("tiers"), "tier_mode", F.array_join("targets", "|").alias("targets"))


def batch_totals(spark, sf):
    studies = table(spark, sf, "part").select("p_size", (F.col("p_size") * 3).alias("slices"), (F.col("p_size") / 4).alias("gb"), F.when(F.col("p_partkey") % 9 == 0, "E").alias("error"))
    return summaries.batch_totals(studies, table(spark, sf, "documents"), "p_size", "slices", "gb", "error", F.col("doc_id") % 4 == 0)


def conformance_totals(spark, sf):
    files = _tagged(spark, sf)
    out = summaries.conformance_totals(files, privacy.conformance(files, "c_custkey", "tags", _TAGS))
    return out.withColumn("avg_pct", F.round("avg_pct", 6)).withColumn("min_pct", F.round("min_pct", 6)).withColumn("max_pct", F.round("max_pct", 6))


def change_counts(spark, sf):
    """Country removed, PatientName blanked, PatientID replaced where there is one."""
    after = lambda t: F.transform_values(F.map_filter(t, lambda k, v: k != "Country"), lambda k, v: F.when(k == "PatientName", "").when(k == "PatientID", F.sha2(v, 256)).when((k == "StudyID") & (v == "None"), "").otherwise(v))
    rows = _tagged(spark, sf).withColumn("after", after(F.col("tags")))
    counts = summaries.change_counts(F.col("tags"), F.col("after"), ["Country"], ["PatientName"], ["PatientID"], [], F.array())
    return rows.agg(*[F.sum(c).alias(n) for n, c in counts.items()])


def custody(spark, sf):
    return summaries.custody(table(spark, sf, "documents"), "source", F.concat(F.lit("archive/"), F.col("source")), F.col("lang") != "xx", F.col("doc_id") >= 0)


def mapped_strict(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return summaries.mapped_strict(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey", "country").select("c_custkey", "country")


def with_pathology(spark, sf):
    return summaries.with_pathology(table(spark, sf, "part").select("p_partkey"))


def chain_reason(spark, sf):
    k = F.col("doc_id")
    label = F.when(k % 10 == 0, "dADC map").otherwise("axial T2")
    reply = F.when(k % 9 == 1, "[label]: not found").when(k % 9 == 2, "possibly subtle, may be faint").when(k % 9 > 3, F.col("text"))
    return table(spark, sf, "documents").select("doc_id", summaries.chain_reason(label, reply, k % 4 == 0, k % 3, F.when(k % 7 == 0, 0.85)).alias("reason"))


def export_rules(spark, sf):
    k = F.col("p_partkey")
    ending = F.element_at(F.array(*map(F.lit, ("nii.gz", "parquet", "JSON", "png", "xyz", "nii"))), (k % 6 + 1).cast("int"))
    path = F.concat(F.lit("./sub 01/"), F.col("p_name"), F.lit("."), ending)
    model = F.concat(F.element_at(F.array(*map(F.lit, ("anthropic/", "google/gemini-", "google/gemma-", "openai/", ""))), (k % 5 + 1).cast("int")), F.lit("m"))
    form, media = exports.media_type(path)
    return table(spark, sf, "part").select("p_partkey", form.alias("format"), media.alias("media"), exports.group_name(path).alias("group_name"), exports.model_family(model).alias("family"), exports.sharpness_label(F.when(k % 8 > 0, F.col("p_size"))).alias("sharpness"))


def safe_values(spark, sf):
    """Host names and whole pages as values of tags: bytes, sequences, texts, and lists of numbers or words."""
    k = F.col("page_id")
    kind = F.when(k % 4 == 0, "bytes").when(k % 4 == 1, "sequence").otherwise("text")
    raw = F.when(k % 4 == 1, k.cast("string")).when(k % 8 == 4, F.col("url")).otherwise(F.col("html"))
    parts = F.concat(k.cast("string"), F.lit("\\"), F.when(k % 3 == 0, "1.5").otherwise("x"))
    return table(spark, sf, "pages").select("page_id", F.md5(briefs.safe_value(raw.cast("binary"), kind)).alias("digest"), briefs.split_value(parts, k % 2 == 0).alias("parts"))


def consensus_brief(spark, sf):
    votes = consensus.consensus(_votes(spark, sf), "series", "sequence_type", "found", "grade", "tier")
    none = F.lit(None).cast("array<string>")
    text_of = briefs.brief(F.concat(F.lit("series "), F.col("series").cast("string")), F.lit(None).cast("string"), F.col("sequence_type"), F.col("agreement"), F.col("quality_grade"), none, F.col("found"), F.col("models_agreeing"), F.col("models_total"), none, none, F.col("tiers_used"), F.col("disagreements"))
    return votes.select("series", text_of.alias("brief"))


def dataset_citation(spark, sf):
    """The tables' totals as the citation record of a dataset, and what it lacks."""
    totals = table(spark, sf, "orders").agg(F.count("*").alias("n"), F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("low"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("high"))
    words = F.concat(F.col("n").cast("string"), F.lit(" orders"))
    record = briefs.citation(F.lit("Orders"), F.array(F.lit("A. Author")), F.lit(""), F.lit(2026), F.lit("10.1/x"), F.array(F.lit("orders")), words, F.col("low"), F.col("high"), F.array(words), F.lit("1"))
    rows = totals.select(record.alias("r"))
    return rows.select(F.to_json("r").alias("record"), F.array_join(briefs.citation_gaps(F.col("r")), "|").alias("gaps"))


def cost_lines(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.when(F.col("o_orderkey") % 2 == 0, F.lit(0.0625))).alias("compute"), F.sum(F.when(F.col("o_orderkey") % 3 == 0, F.lit(0.25))).alias("calls"))
    return per.select("o_custkey", briefs.cost_line("actual", F.col("compute"), F.col("calls")).alias("line"))


QUERIES = {f.__name__: f for f in (subject_numbers, annotation_summary, batch_totals, conformance_totals, change_counts, custody, mapped_strict, with_pathology, chain_reason, export_rules, safe_values, consensus_brief, dataset_citation, cost_lines)}
_FORMAT = "CASE p_partkey % 6 WHEN 1 THEN 'parquet' WHEN 2 THEN 'json' WHEN 3 THEN 'png' END"
_MEDIA = "CASE p_partkey % 6 WHEN 1 THEN 'application/vnd.apache.parquet' WHEN 2 THEN 'application/json' WHEN 3 THEN 'image/png' END"
_ENDING = "CASE p_partkey % 6 WHEN 1 THEN '.parquet' WHEN 2 THEN '.JSON' WHEN 3 THEN '.png' WHEN 4 THEN '.xyz' ELSE '' END"
_REPLY = "CASE WHEN doc_id % 9 = 1 THEN '[label]: not found' WHEN doc_id % 9 = 2 THEN 'possibly subtle, may be faint' WHEN doc_id % 9 > 3 THEN text END"
ORACLE = {
    "subject_numbers": "SELECT c_name, printf('%03d', row_number() OVER (ORDER BY c_name)) AS subject FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL)",
    "annotation_summary": "WITH v AS (SELECT user_id, 'g' AS kind, substr('ABCDF', (event_id % 5 + 1)::INT, 1) AS v FROM events UNION ALL SELECT user_id, 't', event_type FROM events WHERE event_id % 3 > 0 UNION ALL SELECT user_id, 'x', event_type FROM events UNION ALL SELECT user_id, 'x', 't' || (event_id % 4) FROM events WHERE event_id % 2 = 0), c AS (SELECT user_id, kind, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY ALL), w AS (SELECT user_id, coalesce(string_agg(v || ':' || n, '|' ORDER BY v) FILTER (kind = 'g'), '') AS grades, first(v ORDER BY n DESC, v) FILTER (kind = 'g') AS grade_mode, coalesce(string_agg(v || ':' || n, '|' ORDER BY v) FILTER (kind = 't'), '') AS tiers, first(v ORDER BY n DESC, v) FILTER (kind = 't') AS tier_mode, coalesce(string_agg(v, '|' ORDER BY v) FILTER (kind = 'x'), '') AS targets FROM c GROUP BY user_id), e AS (SELECT user_id, count(*) AS n, count_if(event_id % 7 = 0)::BIGINT AS n_findings FROM events GROUP BY user_id) SELECT e.user_id, n, n_findings, grades, grade_mode, tiers, tier_mode, targets FROM e JOIN w ON e.user_id IS NOT DISTINCT FROM w.user_id",
    "batch_totals": "SELECT count(*) AS total_studies, sum(p_size)::BIGINT AS total_files, sum(p_size * 3)::BIGINT AS total_slices, sum(p_size / 4::DOUBLE) AS total_gb, count_if(p_partkey % 9 = 0)::BIGINT AS n_errors, (SELECT count(*) FROM documents) AS series_annotated, (SELECT count_if(doc_id % 4 = 0)::BIGINT FROM documents) AS finding_detected FROM part",
    "conformance_totals": f"WITH {_CONF}, t AS (SELECT count(*) AS total_files FROM customer), i AS (SELECT count(*) AS files_with_issues, round(avg(completeness_pct), 6) AS avg_pct, min(completeness_pct) AS min_pct, max(completeness_pct) AS max_pct FROM conf) SELECT *, round(100 * (1 - files_with_issues / greatest(total_files, 1)::DOUBLE), 1) AS pass_rate FROM t, i",
    "change_counts": "SELECT count(*) AS tags_removed, count_if(c_custkey % 3 = 0 OR c_name <> '')::BIGINT AS tags_blanked, count(*) AS uids_replaced, 0::BIGINT AS dates_shifted, count_if(c_custkey % 5 = 0)::BIGINT AS text_scrubbed, 0::BIGINT AS private_stripped FROM customer",
    "custody": "SELECT source, count(*) AS output_file_count, substr(sha256('archive/' || source), 1, 16) AS source_archive_id, bool_and(coalesce(doc_id >= 0, false)) AS defacing_applied, bool_and(coalesce(lang <> 'xx', false)) AS validation_passed FROM documents GROUP BY source",
    "mapped_strict": "SELECT c_custkey, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "with_pathology": "SELECT p_partkey, 'unknown' AS pathology_flag FROM part",
    "chain_reason": f"WITH a AS (SELECT doc_id, {_REPLY} AS r FROM documents) SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'derivative' WHEN r IS NULL OR starts_with(r, '[') OR starts_with(r, 'Error') THEN 'error' WHEN len(regexp_extract_all(r, '{text.DOUBT}')) >= 2 THEN 'uncertainty' WHEN doc_id % 4 = 0 OR doc_id % 3 > 0 OR doc_id % 7 = 0 THEN 'quality_flags' ELSE 'confident' END AS reason FROM a",
    "export_rules": f"SELECT p_partkey, {_FORMAT} AS format, {_MEDIA} AS media, 'sub_01/' || regexp_replace(p_name || {_ENDING}, '[^A-Za-z0-9._-]', '_', 'g') AS group_name, CASE p_partkey % 5 WHEN 0 THEN 'anthropic' WHEN 1 THEN 'google' WHEN 2 THEN 'other' ELSE 'openai' END AS family, CASE WHEN p_partkey % 8 = 0 THEN NULL WHEN p_size > 20 THEN 'very sharp' WHEN p_size > 10 THEN 'sharp' WHEN p_size > 5 THEN 'moderate' ELSE 'soft/blurry' END AS sharpness FROM part",
}
_MONEY = lambda v: f"coalesce('$' || printf('%.4f', {v}), 'n/a')"
ORACLE["safe_values"] = """SELECT page_id, md5(CASE page_id % 4 WHEN 0 THEN CASE WHEN page_id % 8 = 4 THEN CASE WHEN strlen(url) <= 64 THEN lower(hex(encode(url))) ELSE '[bytes: ' || strlen(url) || ']' END WHEN strlen(html) <= 64 THEN lower(hex(encode(html))) ELSE '[bytes: ' || strlen(html) || ']' END
WHEN 1 THEN '[Sequence: ' || page_id || ' items]' ELSE html END) AS digest, CASE WHEN page_id % 6 = 0 THEN '[' || page_id || '.0,1.5]' ELSE '["' || page_id || '","' || CASE WHEN page_id % 3 = 0 THEN '1.5' ELSE 'x' END || '"]' END AS parts FROM pages"""
ORACLE["consensus_brief"] = f"""WITH f AS ({_FULL}) SELECT series, '### series ' || series || chr(10) || concat_ws(chr(10), '- Sequence: **' || sequence_type || '** (agreement ' || CAST(round_even(agreement * 100, 0) AS BIGINT) || '%)', '- Quality grade: **' || quality_grade || '**',
CASE WHEN found THEN '- **Pathology** (' || models_agreeing || '/' || models_total || ' models):' ELSE '{briefs.NONE_FLAGGED}' END, '{briefs.HEADS['notable']}' || replace(tiers, '|', '; '), CASE WHEN disagreements <> '' THEN '{briefs.HEADS['disputed']}' || replace(disagreements, '|', ', ') END) AS brief FROM f"""
ORACLE["dataset_citation"] = """WITH t AS (SELECT count(*) || ' orders' AS w, strftime(min(o_orderdate), '%Y-%m-%d') || '/' || strftime(max(o_orderdate), '%Y-%m-%d') AS d FROM orders)
SELECT '{"identifiers":[{"identifier":"https://doi.org/10.1/x","identifierType":"DOI"}],"creators":[{"name":"A. Author","nameType":"Personal"}],"titles":[{"title":"Orders","titleType":"Main"}],"publisher":"","publicationYear":"2026","types":{"resourceTypeGeneral":"Dataset"},"subjects":[{"subject":"orders"}],"descriptions":[{"description":"' || w || '","descriptionType":"Abstract"}],"dates":[{"date":"' || d || '","dateType":"Collected"}],"sizes":["' || w || '"],"version":"1","schemaVersion":"http://datacite.org/schema/kernel-4"}' AS record, 'publisher' AS gaps FROM t"""
ORACLE["cost_lines"] = f"""WITH a AS (SELECT o_custkey, sum(CASE WHEN o_orderkey % 2 = 0 THEN 0.0625::DOUBLE END) AS m, sum(CASE WHEN o_orderkey % 3 = 0 THEN 0.25::DOUBLE END) AS c FROM orders GROUP BY 1)
SELECT o_custkey, 'actual: compute=' || {_MONEY('m')} || ' calls=' || {_MONEY('c')} || ' total=' || {_MONEY('CASE WHEN m IS NOT NULL OR c IS NOT NULL THEN coalesce(m, 0) + coalesce(c, 0) END')} AS line FROM a"""
