"""Privacy, conformance, consensus, routing, profiles and integrity over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from radspan.functions.scoring import cuts_sql, letter
from radspan.operators import consensus, gates, integrity, privacy, profile, release
from radspan.plans.proxies import SERIES, series, table

# patterns that mean the same in Java and RE2
_BOTH = {k: privacy.SCAN[k] for k in ("ssn", "phone_us", "pan", "voter_id", "driving_license", "passport", "uhid", "email", "url", "timestamp_ist", "mrn_like")} | {k: privacy.EXTENDED[k] for k in ("ipv4", "phone_paren", "hex_token")}
_SCRUB = {"email": privacy.SCAN["email"], "url": privacy.SCAN["url"], "ipv4": privacy.EXTENDED["ipv4"], "phone_paren": privacy.EXTENDED["phone_paren"], "hex_token": privacy.EXTENDED["hex_token"]}
# all patterns; extensions come before the scrubber's own, whose 12 digits would leave the rest of a longer number
_ALL_SCAN = privacy.SCAN | privacy.EXTENDED
_ALL_SCRUB = privacy.EXTENDED | privacy.SCRUB
_TAGS = ["PatientID", "PatientName", "Country", "StudyID", "PatientComments", "PatientTelephoneNumbers"]


def _tagged(spark, sf):
    """Customers as tag maps, with gaps by rule."""
    k = F.col("c_custkey")
    values = {"PatientID": k.cast("string"), "PatientName": F.when(k % 3 > 0, F.col("c_name")), "Country": F.when(k % 4 > 0, F.col("c_nationkey").cast("string")), "StudyID": F.when(k % 5 == 0, "None").otherwise(F.col("c_mktsegment")), "PatientComments": F.when(k % 7 == 0, ""), "PatientTelephoneNumbers": F.when(k % 6 == 0, "555")}
    pairs = [x for n, v in values.items() for x in (F.lit(n), v)]
    return table(spark, sf, "customer").select(k, F.create_map(*pairs).alias("tags"))


_TAGGED = """t(c_custkey, category, tag, v) AS (
SELECT c_custkey, u.category, u.tag, CASE u.tag WHEN 'PatientID' THEN CAST(c_custkey AS VARCHAR) WHEN 'PatientName' THEN CASE WHEN c_custkey % 3 > 0 THEN c_name END WHEN 'Country' THEN CASE WHEN c_custkey % 4 > 0 THEN CAST(c_nationkey AS VARCHAR) END
 WHEN 'StudyID' THEN CASE WHEN c_custkey % 5 = 0 THEN 'None' ELSE c_mktsegment END WHEN 'PatientComments' THEN CASE WHEN c_custkey % 7 = 0 THEN '' END WHEN 'PatientTelephoneNumbers' THEN CASE WHEN c_custkey % 6 = 0 THEN '555' END END
FROM customer, (VALUES ('1. Names', 'PatientName'), ('2. Geographic data', 'Country'), ('4. Phone numbers', 'PatientTelephoneNumbers'), ('6. Email addresses', 'PatientComments'), ('7. Social Security numbers', 'PatientID'), ('8. Medical record numbers', 'PatientID'), ('10. Account numbers', 'StudyID')) u(category, tag)),
found AS (SELECT *, trim(v) NOT IN ('', 'None', '0') AS f FROM t WHERE v IS NOT NULL)"""


def hipaa_inventory(spark, sf):
    return privacy.inventory(_tagged(spark, sf), "c_custkey", "tags")


def hipaa_score(spark, sf):
    out = privacy.may_publish(privacy.compliance(hipaa_inventory(spark, sf), "c_custkey"))
    return out.withColumn("score", F.round("score", 8))


def hipaa_files(spark, sf):
    return privacy.file_risk(hipaa_inventory(spark, sf), "c_custkey").withColumn("categories", F.array_join("categories", "|"))


def hipaa_recommendations(spark, sf):
    return privacy.recommendations(hipaa_inventory(spark, sf), "c_custkey").withColumn("place", F.col("place").cast("long"))


def phi_totals(spark, sf):
    tags = F.create_map(F.lit("PatientComments"), F.col("text"), F.lit("SeriesInstanceUID"), F.lit("123-45-6789"))
    rows = table(spark, sf, "documents").select("doc_id", tags.alias("tags"), F.when(F.col("text").isNull(), "unreadable").alias("error"))
    return privacy.scan_totals(rows, "doc_id", "tags", "error", _BOTH)


def study_validation(spark, sf):
    """Documents as files, sources as studies: every validator of every study, and the verdict."""
    private = F.when(F.col("doc_id") % 50 == 0, F.create_map(F.lit("(0009,1001)"), F.lit("x"), F.lit("(0010,0010)"), F.lit("x"))).otherwise(F.create_map(F.lit("(0010,0010)"), F.lit("x")))
    tags = F.map_concat(F.create_map(F.lit("PatientComments"), F.col("text"), F.lit("SeriesInstanceUID"), F.lit("123-45-6789")), private)
    rows = table(spark, sf, "documents").select("source", tags.alias("tags"), F.when(F.col("text").isNull(), "unreadable").alias("error"), (F.length("text") % 97 == 0).alias("burned"))
    report = gates.study_validation(rows, "source", "tags", "error", "burned", _BOTH)
    told = gates.verdicts(report, "source").select(F.col("source").alias("_source"), F.col("passed").alias("study_passed"), F.array_join("failures", "; ").alias("failures"))
    return report.join(told, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _released(spark, sf):
    """Documents as files of sources: a name, an id, private tags in some, and the text as an unlisted tag; whole profile and patterns."""
    k = F.col("doc_id")
    tags = F.create_map(F.lit("PatientName"), F.col("lang"), F.lit("SeriesInstanceUID"), k.cast("string"), F.lit("Remarks"), F.col("text"))
    private = F.create_map(F.lit("(0009,1001)"), F.lit("x"))
    rows = table(spark, sf, "documents").select("doc_id", "source", F.when(k % 50 == 0, F.map_concat(tags, private)).otherwise(tags).alias("tags"), F.when(k % 41 == 40, "unreadable").alias("error"), F.when(k % 3 > 0, k % 7 > 0).alias("defaced"), (k % 97 == 0).alias("burned"))
    return release.outcomes(rows, "source", "doc_id", "tags", "error", F.col("source"), "salt", "defaced", "burned", scrubbed=_ALL_SCRUB)


def release_stages(spark, sf):
    return release.report(_released(spark, sf)).withColumnRenamed("study", "source")


def release_custody(spark, sf):
    return release.custody_heads(_released(spark, sf)).withColumnRenamed("study", "source")


def release_files(spark, sf):
    rows = _released(spark, sf)
    return rows.select(F.col("path").alias("doc_id"), "ok", "identifiers", "sha256", F.array_join(F.transform("stages", lambda s: s["outcome"]), "|").alias("outcomes"))


def phi_regex_scan(spark, sf):
    return privacy.scan(table(spark, sf, "documents"), "doc_id", "text", _BOTH).groupBy("doc_id", "pattern").agg(F.count("*").alias("n"), F.min("match").alias("first"))


def phi_scan_report(spark, sf):
    return privacy.scan_report(table(spark, sf, "documents"), "doc_id", "text", _BOTH)


def phi_scan_all(spark, sf):
    """All patterns, those with look-behind too."""
    return privacy.scan_report(table(spark, sf, "documents"), "doc_id", "text", privacy.SCAN | privacy.EXTENDED)


def text_scrub(spark, sf):
    rows = privacy.scrub_with_names(table(spark, sf, "documents").select("doc_id", "text"), "text", _SCRUB)
    return rows.select("doc_id", F.md5("scrubbed").alias("digest"), F.array_join("scrubbed_by", "|").alias("by"))


def phi_scan_documents(spark, sf):
    """All patterns by document."""
    return privacy.scan(table(spark, sf, "documents"), "doc_id", "text", _ALL_SCAN).groupBy("doc_id", "pattern").agg(F.count("*").alias("n"), F.min("match").alias("first"))


def text_scrub_all(spark, sf):
    """The whole scrubber and the extensions."""
    rows = privacy.scrub_with_names(table(spark, sf, "documents").select("doc_id", "text"), "text", _ALL_SCRUB)
    return rows.select("doc_id", F.md5("scrubbed").alias("digest"), F.array_join("scrubbed_by", "|").alias("by"))


def uid_pseudonym(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", privacy.pseudonym(F.col("o_orderkey"), "salt").alias("uid"))


def date_shift_patient(spark, sf):
    day = F.when(F.col("o_orderkey") % 9 == 0, "20241340").when(F.col("o_orderkey") % 11 == 0, "2024").otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("1015.5")))
    return table(spark, sf, "orders").select("o_orderkey", privacy.shift_date(day, privacy.shift_days(F.col("o_custkey"))).alias("day"))


def date_shift_global(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", privacy.shift_date(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(-100)).alias("day"))


def deid_profile(spark, sf):
    rows = privacy.deidentified(_tagged(spark, sf), "tags", F.col("c_custkey"), "s", ["PatientTelephoneNumbers"], ["PatientName"], ["PatientID"], [], ["PatientComments"])
    return rows.select("c_custkey", *[F.try_element_at("tags", F.lit(t)).alias(t.lower()) for t in _TAGS])


def conformance(spark, sf):
    return privacy.conformance(_tagged(spark, sf), "c_custkey", "tags", _TAGS).select("c_custkey", F.array_join("missing_tags", "|").alias("missing"), F.col("missing_count").cast("long").alias("missing_count"), F.round("completeness_pct", 6).alias("completeness_pct"))


def conformance_summary(spark, sf):
    return conformance(spark, sf).agg(F.round(F.avg("completeness_pct"), 6).alias("avg_pct"), F.min("completeness_pct").alias("min_pct"), F.max("completeness_pct").alias("max_pct"), F.count("*").alias("n_issues"))


def constraint_failures(spark, sf):
    rules = {"discount": F.col("l_discount").between(0.0, 0.08), "quantity": F.col("l_quantity") <= 45, "flag": F.col("l_returnflag").isin("A", "N")}
    return privacy.constraint_failures(table(spark, sf, "lineitem"), "l_orderkey", rules).groupBy("l_orderkey", "rule").agg(F.count("*").alias("n"))


def _votes(spark, sf):
    e = table(spark, sf, "events")
    return e.select("user_id", F.col("event_type").alias("sequence_type"), (F.col("event_id") % 4 == 0).alias("found"), F.substring(F.lit("ABCDFX"), (F.col("event_id") % 6 + 1).cast("int"), 1).alias("grade"), F.when(F.col("event_id") % 10 == 0, "premium").otherwise("cheap").alias("tier"), F.pmod("event_id", F.lit(400)).alias("series"))


def consensus_vote(spark, sf):
    out = consensus.majority(_votes(spark, sf), "series", "sequence_type")
    return out.withColumn("agreement", F.round("agreement", 8))


def consensus_full(spark, sf):
    out = consensus.consensus(_votes(spark, sf), "series", "sequence_type", "found", "grade", "tier")
    return out.select("series", "sequence_type", F.round("agreement", 8).alias("agreement"), "found", "models_agreeing", "models_total", "quality_grade", F.round("confidence", 8).alias("confidence"), "needs_escalation", F.array_join("tiers_used", "|").alias("tiers"), "premium_used", F.array_join("disagreements", "|").alias("disagreements"))


def consensus_union(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return consensus.first_distinct(rows, "user_id", "event_type", "event_id", 3).withColumn("place", F.col("place").cast("long"))


def escalation(spark, sf):
    rows = consensus_full(spark, sf)
    return rows.groupBy("needs_escalation").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("confidence"))


def routing_cascade(spark, sf):
    e = table(spark, sf, "events").select(F.pmod("event_id", F.lit(2500)).alias("series"), F.col("event_id").alias("ord"), "value", F.get_json_object("props", "$.k").cast("long").alias("k"))
    out = consensus.route(e, "series", "ord", F.col("k") % 3 == 0, (F.col("k") * 4500 + 1500) / 1e6)
    return out.withColumn("cost", F.round("cost", 8))


def corpus_cost(spark, sf):
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("model"), (F.lit(0.5) + F.col("n_regionkey") / 10).alias("hit_rate"), ((F.col("n_nationkey") + 1) * F.lit(0.001)).alias("cost_per_call"))
    return consensus.corpus_cost(rows, 34574).select("ord", "model", F.round("calls", 6).alias("calls"), F.round("spend", 6).alias("spend"))


def plan_estimate(spark, sf):
    out = consensus.plan_estimate(series(spark, sf), "study_id", F.col("quality_grade") == "F", 30, 50, 0.00666)
    return out.select("n_studies", "n_series", "n_pending", F.round("dollars", 6).alias("dollars"), F.round("minutes", 6).alias("minutes"))


def column_profile(spark, sf):
    return profile.column_profile(table(spark, sf, "part")).withColumn("n_unique", F.col("n_unique").cast("long")).withColumn("null_pct", F.col("null_pct").cast("double"))


def numeric_profile(spark, sf):
    out = profile.numeric_profile(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "median", "std", "p25", "p75")])


def string_profile(spark, sf):
    return profile.string_profile(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"]).withColumn("mean_length", F.round("mean_length", 6))


def type_breakdown(spark, sf):
    return profile.breakdown(table(spark, sf, "pages"), F.regexp_extract("url", r"^(\w+://[^/]+)", 1))


def error_breakdown(spark, sf):
    return profile.breakdown(table(spark, sf, "events").where("event_type = 'error'"), F.element_at(F.split(F.concat(F.lit("E"), F.col("user_id") % 7, F.lit(": x")), ":"), 1))


def month_histogram(spark, sf):
    return profile.month_histogram(table(spark, sf, "orders"), "o_orderdate")


def keyword_buckets(spark, sf):
    rows = table(spark, sf, "part")
    return profile.keyword_buckets(rows, F.col("p_name"), ["small", "ring", "blue"], F.col("p_size").cast("long"))


def coverage_matrix(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return profile.coverage_matrix(rows, "c_mktsegment", "o_orderpriority")


def checksum_manifest(spark, sf):
    return integrity.checksums(table(spark, sf, "documents"), "doc_id", "text")


def checksum_verify(spark, sf):
    d = table(spark, sf, "documents")
    was = integrity.checksums(d, "doc_id", "text").withColumn("sha256", F.when(F.col("doc_id") % 50 == 3, "x").otherwise(F.col("sha256")))
    return integrity.verify(was, integrity.checksums(d, "doc_id", "text"), "doc_id")


def prov_edges(spark, sf):
    return integrity.provenance_pairs(table(spark, sf, "documents").select("source", "doc_id").distinct(), "source", "doc_id", "extract")


def study_qc(spark, sf):
    out = integrity.study_qc(series(spark, sf), "study_id", "quality_grade", "series_key", F.col("field_strength_T") > 0.07, F.size(integrity.anomaly_flags(F.col("score"), F.col("field_strength_T") * 20, F.lit(0))) > 0)
    return out.withColumn("pass_pct", F.round("pass_pct", 6))


def series_order(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("x"), "p_size")).otherwise(F.col("p_size").cast("string")).alias("n"))
    return integrity.place(rows, ["p_brand"], [*integrity.numbered_first("n"), F.col("p_partkey")])


def slice_order(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name", F.when(F.col("p_size") > 10, F.col("p_size")).alias("z"))
    return integrity.place(rows, ["p_brand"], [*integrity.slice_order("z", "p_partkey", "p_name")]).drop("p_name")


def topk_worst(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(20)


def record_binning(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    return integrity.bind_records(rows, table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("orders"))


def ragged_union(spark, sf):
    a = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    return a.unionByName(table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url"), allowMissingColumns=True)


def set_algebra(spark, sf):
    a, b = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    out = [(n, d.distinct()) for n, d in (("both", a.intersect(b)), ("only_second", b.subtract(a)), ("either", a.union(b)))]
    return out[0][1].withColumn("op", F.lit("both")).unionByName(out[1][1].withColumn("op", F.lit("only_second"))).unionByName(out[2][1].withColumn("op", F.lit("either")))


def dedupe_first(spark, sf):
    return integrity.first_per_key(table(spark, sf, "pages").select(F.regexp_extract("url", r"^(\w+://[^/]+)", 1).alias("host"), "page_id", "url"), ["host"], ["page_id"])


def resource_check(spark, sf):
    rows = integrity.checksums(table(spark, sf, "pages"), "page_id", "html").join(table(spark, sf, "pages").select("page_id", "url"), "page_id")
    rules = integrity.resource_rules(F.regexp_replace("url", "[^a-z0-9]+", "-"), F.col("url"), F.col("bytes") - 2000, F.col("sha256"))
    return privacy.constraint_failures(rows, "page_id", rules)


def grade_letters(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_quantity") * 2).alias("score"))
    return rows.groupBy(letter(F.col("score")).alias("grade")).agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("orders"))


_V = "v AS (SELECT event_id % 400 AS series, event_type AS sequence_type, event_id % 4 = 0 AS found, substr('ABCDFX', CAST(event_id % 6 + 1 AS INT), 1) AS grade, CASE WHEN event_id % 10 = 0 THEN 'premium' ELSE 'cheap' END AS tier FROM events)"
_MAJ = "c AS (SELECT series, sequence_type, count(*) AS n FROM v GROUP BY ALL), m AS (SELECT series, sequence_type, n / (sum(n) OVER (PARTITION BY series))::DOUBLE AS agreement, CAST(sum(n) OVER (PARTITION BY series) AS BIGINT) AS n_votes, row_number() OVER (PARTITION BY series ORDER BY n DESC, sequence_type) AS r FROM c)"
_FULL = f"""WITH {_V}, {_MAJ}, g AS (SELECT series, bool_or(found) AS found, count_if(found)::BIGINT AS pos, count(*) AS n, round_even(coalesce(avg(CASE grade WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 WHEN 'F' THEN 0 END), 0), 0) AS gm, array_to_string(list_sort(list_distinct(list(tier))), '|') AS tiers, bool_or(tier = 'premium') AS premium_used FROM v GROUP BY series)
SELECT g.series, sequence_type, round(agreement, 8) AS agreement, found, CASE WHEN found THEN pos ELSE n - pos END AS models_agreeing, n AS models_total, CASE gm WHEN 4 THEN 'A' WHEN 3 THEN 'B' WHEN 2 THEN 'C' WHEN 1 THEN 'D' ELSE 'F' END AS quality_grade,
round(0.6::DOUBLE * agreement + 0.4::DOUBLE * (greatest(pos, n - pos) / n::DOUBLE), 8) AS confidence, agreement <= 0.5::DOUBLE OR greatest(pos, n - pos) / n::DOUBLE < 0.67::DOUBLE AS needs_escalation, tiers, premium_used,
concat_ws('|', CASE WHEN agreement < 1 THEN 'sequence_type' END, CASE WHEN pos > 0 AND pos < n THEN 'pathology_found' END) AS disagreements FROM g JOIN m ON g.series = m.series AND r = 1"""
_SCANS = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS pattern, unnest(regexp_extract_all(text, '{p}')) AS match FROM documents" for k, p in _BOTH.items())
_LEFT = ["text"]
for _p in _SCRUB.values():
    _LEFT.append(f"regexp_replace({_LEFT[-1]}, '{_p}', '', 'g')")
# RE2 has no look-around: runs of digits stand between chr(1) and chr(2), a plus after a digit becomes chr(3)
_INDIA = r"\x010\d{10}\x02|\+\x0191(?:\x02[\s-]\x01)?\d{10}\x02"


def _runs(x):
    return f"regexp_replace(regexp_replace({x}, '(\\d)\\+', '\\1' || chr(3), 'g'), '(\\d+)', chr(1) || '\\1' || chr(2), 'g')"


def _no_runs(x):
    return f"replace(regexp_replace({x}, '[\\x01\\x02]', '', 'g'), chr(3), '+')"


def _found_sql(name, p):
    if name == "phone_india":
        return f"list_transform(regexp_extract_all({_runs('text')}, '{_INDIA}'), lambda m: {_no_runs('m')})"
    return f"regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}')"


def _deleted_sql(name, p, x):
    if name == "phone_india":
        return _no_runs(f"regexp_replace({_runs(x)}, '{_INDIA}', '', 'g')")
    return f"regexp_replace({x}, '{p.replace(chr(39), chr(39) * 2)}', '', 'g')"


_SCANS_ALL = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS pattern, unnest({_found_sql(k, p)}) AS match FROM documents WHERE length(text) >= 3" for k, p in _ALL_SCAN.items())
_STEPS = ", ".join(["s0 AS (SELECT doc_id, text AS t0 FROM documents)", *[f"s{i} AS (SELECT *, {_deleted_sql(k, p, f't{i - 1}')} AS t{i} FROM s{i - 1})" for i, (k, p) in enumerate(_ALL_SCRUB.items(), 1)]])
_BY = ", ".join(f"CASE WHEN t{i - 1} <> t{i} THEN '{k}' END" for i, k in enumerate(_ALL_SCRUB, 1))
_NUM = " UNION ALL ".join(f"SELECT '{c}' AS column, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS std, round(list_sort(list({c}))[1 + CAST(floor(0.25::DOUBLE * (count(*) - 1) + 0.5) AS BIGINT)], 6) AS p25, round(list_sort(list({c}))[1 + CAST(floor(0.75::DOUBLE * (count(*) - 1) + 0.5) AS BIGINT)], 6) AS p75 FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount"))
_STR = " UNION ALL ".join(f"SELECT '{c}' AS column, (SELECT count(DISTINCT {c}) FROM part) AS n_unique, (SELECT {c} FROM part GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_frequent, (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY {c})) AS frequency, (SELECT round(avg(length({c})), 6) FROM part) AS mean_length" for c in ("p_name", "p_brand", "p_type"))
_COLS = " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls, (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_pct, count(DISTINCT {c}) + max(({c} IS NULL)::INT) AS n_unique FROM part" for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))
_SHIFT = "CAST('0x' || substr(sha256(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT)"
_UID = "CAST(CAST('0x' || substr(sha256('salt' || o_orderkey), 1, 12) AS BIGINT) AS HUGEINT) * 281474976710656 + CAST('0x' || substr(sha256('salt' || o_orderkey), 13, 12) AS BIGINT)"
_MISSING = ", ".join(f"CASE WHEN coalesce((SELECT 1), 0) = 1 AND {c} THEN '{t}' END" for t, c in (("PatientName", "c_custkey % 3 = 0"), ("Country", "c_custkey % 4 = 0"), ("StudyID", "c_custkey % 5 = 0"), ("PatientComments", "true"), ("PatientTelephoneNumbers", "c_custkey % 6 > 0"))).replace("coalesce((SELECT 1), 0) = 1 AND ", "")
_CONF = f"x AS (SELECT c_custkey, list_filter(list_value({_MISSING}), lambda t: t IS NOT NULL) AS m FROM customer), conf AS (SELECT c_custkey, array_to_string(m, '|') AS missing, len(m)::BIGINT AS missing_count, round((6 - len(m)) * 100.0::DOUBLE / 6, 6) AS completeness_pct FROM x WHERE len(m) > 0)"

QUERIES = {f.__name__: f for f in (hipaa_inventory, hipaa_score, hipaa_files, hipaa_recommendations, phi_totals, study_validation, release_stages, release_custody, release_files, phi_regex_scan, phi_scan_report, phi_scan_all, phi_scan_documents, text_scrub, text_scrub_all, uid_pseudonym, date_shift_patient, date_shift_global, deid_profile, conformance, conformance_summary, constraint_failures, consensus_vote, consensus_full, consensus_union, escalation, routing_cascade, corpus_cost, plan_estimate, column_profile, numeric_profile, string_profile, type_breakdown, error_breakdown, month_histogram, keyword_buckets, coverage_matrix, checksum_manifest, checksum_verify, prov_edges, study_qc, series_order, slice_order, topk_worst, record_binning, ragged_union, set_algebra, dedupe_first, resource_check, grade_letters)}
ORACLE = {
    "hipaa_inventory": f"WITH {_TAGGED} SELECT c_custkey, category, tag, f AS found FROM found",
    "hipaa_files": f"WITH {_TAGGED}, a AS (SELECT c_custkey, count_if(f)::BIGINT AS n_found, count_if(NOT f)::BIGINT AS n_empty, list_sort(list_filter(list_distinct(list(CASE WHEN f THEN category END)), lambda x: x IS NOT NULL)) AS cs FROM found GROUP BY c_custkey), b AS (SELECT *, len(list_filter(cs, lambda x: x IN ('1. Names', '2. Geographic data', '4. Phone numbers', '6. Email addresses', '7. Social Security numbers'))) AS s FROM a) SELECT c_custkey, n_found, n_empty, array_to_string(cs, '|') AS categories, CASE WHEN s >= 3 THEN 'high' WHEN s >= 1 THEN 'medium' WHEN len(cs) > 0 THEN 'low' ELSE 'none' END AS risk FROM b",
    "hipaa_score": f"WITH {_TAGGED}, a AS (SELECT c_custkey, count(DISTINCT CASE WHEN f AND category IN ('1. Names', '2. Geographic data', '4. Phone numbers', '6. Email addresses', '7. Social Security numbers') THEN category END) AS s, count_if(f) AS n FROM found GROUP BY 1), r AS (SELECT count_if(s >= 3)::BIGINT AS n_high, count_if(s BETWEEN 1 AND 2)::BIGINT AS n_medium, count_if(s = 0 AND n > 0)::BIGINT AS n_low, count_if(n = 0)::BIGINT AS n_none FROM a), t2 AS (SELECT count_if(f)::BIGINT AS n_found, count(*) AS n_checked, count(DISTINCT CASE WHEN f THEN category END) AS n_categories FROM found), s AS (SELECT *, round(greatest(0, 100 - 50 * (n_found / n_checked::DOUBLE) - 50 * n_categories / 18::DOUBLE), 8) AS score FROM t2, r) SELECT *, NOT (score < 90 AND n_high > 0) AS publish FROM s",
    "phi_regex_scan": f"WITH m AS ({_SCANS}) SELECT doc_id, pattern, count(*) AS n, min(match) AS first FROM m GROUP BY ALL",
    "phi_scan_report": f"WITH m AS ({_SCANS}) SELECT pattern, count(*) AS matches, count(DISTINCT doc_id) AS files FROM m GROUP BY pattern",
    "text_scrub": f"SELECT doc_id, md5(trim(regexp_replace({_LEFT[-1]}, '\\s{{2,}}', ' ', 'g'))) AS digest, concat_ws('|', {', '.join(f'CASE WHEN {a} <> {b} THEN {chr(39)}{n}{chr(39)} END' for n, a, b in zip(_SCRUB, _LEFT, _LEFT[1:]))}) AS by FROM documents",
    "phi_scan_documents": f"WITH m AS ({_SCANS_ALL}) SELECT doc_id, pattern, count(*) AS n, min(match) AS first FROM m GROUP BY ALL",
    "text_scrub_all": f"WITH {_STEPS} SELECT doc_id, md5(trim(regexp_replace(t{len(_ALL_SCRUB)}, '\\s{{2,}}', ' ', 'g'))) AS digest, concat_ws('|', {_BY}) AS by FROM s{len(_ALL_SCRUB)}",
    "uid_pseudonym": f"SELECT o_orderkey, substr('{privacy.UID_ROOT}' || CAST({_UID} AS VARCHAR), 1, 64) AS uid FROM orders",
    "date_shift_patient": f"SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN '2024' ELSE strftime(CAST(o_orderdate AS DATE) + CAST(-365 + {_SHIFT} % 336 AS INT), '%Y%m%d') || '1015.5' END AS day FROM orders",
    "date_shift_global": "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 100, '%Y%m%d') AS day FROM orders",
    "deid_profile": f"SELECT c_custkey, substr('{privacy.UID_ROOT}' || CAST({_UID.replace('o_orderkey', 'c_custkey').replace(chr(39) + 'salt' + chr(39), chr(39) + 's' + chr(39))} AS VARCHAR), 1, 64) AS patientid, '' AS patientname, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS country, CASE WHEN c_custkey % 5 = 0 THEN 'None' ELSE c_mktsegment END AS studyid, CASE WHEN c_custkey % 7 = 0 THEN '' END AS patientcomments, NULL::VARCHAR AS patienttelephonenumbers FROM customer",
    "conformance": f"WITH {_CONF} SELECT * FROM conf",
    "conformance_summary": f"WITH {_CONF} SELECT round(avg(completeness_pct), 6) AS avg_pct, min(completeness_pct) AS min_pct, max(completeness_pct) AS max_pct, count(*) AS n_issues FROM conf",
    "constraint_failures": "WITH a AS (SELECT l_orderkey, 'discount' AS rule FROM lineitem WHERE NOT l_discount BETWEEN 0.0::DOUBLE AND 0.08::DOUBLE UNION ALL SELECT l_orderkey, 'quantity' FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT l_orderkey, 'flag' FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')) SELECT l_orderkey, rule, count(*) AS n FROM a GROUP BY ALL",
    "consensus_vote": f"WITH {_V}, {_MAJ} SELECT series, sequence_type, round(agreement, 8) AS agreement, n_votes FROM m WHERE r = 1",
    "consensus_full": _FULL,
    "consensus_union": "WITH a AS (SELECT user_id, event_type, min(event_id) AS f FROM events GROUP BY ALL), b AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY f) AS place FROM a) SELECT * FROM b WHERE place <= 3",
    "escalation": f"SELECT needs_escalation, count(*) AS n, round(avg(confidence), 6) AS confidence FROM ({_FULL}) GROUP BY 1",
    "routing_cascade": "WITH e AS (SELECT event_id % 2500 AS series, event_id AS ord, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events), w AS (SELECT series, min(CASE WHEN k % 3 = 0 THEN ord END) AS winner FROM e GROUP BY series) SELECT e.series, w.winner, count_if(w.winner IS NULL OR ord < w.winner)::BIGINT AS misses, round(sum((k * 4500 + 1500) / 1e6), 8) AS cost FROM e JOIN w ON e.series = w.series WHERE w.winner IS NULL OR ord <= w.winner GROUP BY ALL",
    "corpus_cost": "WITH p AS (SELECT n_nationkey AS ord, n_name AS model, 0.5::DOUBLE + n_regionkey / 10::DOUBLE AS h, (n_nationkey + 1) * 0.001::DOUBLE AS c FROM nation), q AS (SELECT *, 34574 * list_product(coalesce(list(1 - h) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), [1.0::DOUBLE])) AS calls FROM p) SELECT ord, model, round(calls, 6) AS calls, round(calls * c, 6) AS spend FROM q",
    "plan_estimate": f"WITH {SERIES}, a AS (SELECT count(DISTINCT study_id) AS n_studies, count(*) AS n_series, count_if(quality_grade = 'F')::BIGINT AS n_pending FROM series) SELECT *, round(n_pending * 0.00666::DOUBLE, 6) AS dollars, round(ceil(n_pending / 50::DOUBLE) * 30 / 60, 6) AS minutes FROM a",
    "column_profile": _COLS,
    "numeric_profile": _NUM,
    "string_profile": _STR,
    "type_breakdown": "SELECT regexp_extract(url, '^(\\w+://[^/]+)', 1) AS key, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, key LIMIT 10",
    "error_breakdown": "SELECT 'E' || (user_id % 7) AS key, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY n DESC, key LIMIT 10",
    "month_histogram": "SELECT substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS month, count(*) AS n FROM orders GROUP BY 1",
    "keyword_buckets": "SELECT CASE WHEN lower(p_name) LIKE '%small%' THEN 'small' WHEN lower(p_name) LIKE '%ring%' THEN 'ring' WHEN lower(p_name) LIKE '%blue%' THEN 'blue' ELSE 'Other' END AS bucket, sum(p_size)::BIGINT AS n FROM part GROUP BY 1",
    "coverage_matrix": "WITH o AS (SELECT c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey), s AS (SELECT c_mktsegment AS row, count(*) / (SELECT count(*) FROM o)::DOUBLE AS sh FROM o GROUP BY 1), c AS (SELECT o_orderpriority AS col, count(*) AS n FROM o GROUP BY 1) SELECT row, col AS column, CAST(floor(c.n * sh + 1e-9::DOUBLE) AS BIGINT) AS n FROM s, c",
    "checksum_manifest": "SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS bytes FROM documents",
    "checksum_verify": "SELECT doc_id, 'mismatch' AS problem FROM documents WHERE doc_id % 50 = 3",
    "prov_edges": "SELECT DISTINCT 'wasGeneratedBy' AS edge, source, 'extract' AS target FROM documents UNION ALL SELECT DISTINCT 'used', 'extract', CAST(doc_id AS VARCHAR) FROM documents UNION ALL SELECT DISTINCT 'wasDerivedFrom', source, CAST(doc_id AS VARCHAR) FROM documents",
    "study_qc": f"WITH {SERIES} SELECT study_id, {', '.join(f'count_if(quality_grade = {chr(39)}{g}{chr(39)})::BIGINT AS n_{g.lower()}' for g in 'ABCDF')}, count(DISTINCT CASE WHEN field_strength_T > 0.07::DOUBLE THEN series_key END) AS n_issues, count_if(score > 50 OR field_strength_T * 20 < 0.85::DOUBLE)::BIGINT AS n_anomalies, count(*) AS n, round((1 - count(DISTINCT CASE WHEN field_strength_T > 0.07::DOUBLE THEN series_key END) / count(*)::DOUBLE) * 100, 6) AS pass_pct FROM series GROUP BY study_id",
    "series_order": "WITH a AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 3 = 0 THEN 'x' || p_size ELSE CAST(p_size AS VARCHAR) END AS n FROM part) SELECT p_partkey, p_brand, n, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY try_cast(n AS INT) IS NULL, try_cast(n AS INT), n, p_partkey) AS INT) AS place FROM a",
    "slice_order": "WITH a AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 10 THEN p_size END AS z FROM part) SELECT p_partkey, p_brand, z, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY z NULLS LAST, p_partkey) AS INT) AS place FROM a",
    "topk_worst": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20",
    "record_binning": "SELECT p_brand, count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
    "ragged_union": "SELECT doc_id AS id, lang, NULL::VARCHAR AS url FROM documents UNION ALL SELECT page_id, NULL, url FROM pages",
    "set_algebra": "SELECT k, 'both' AS op FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT k, 'only_second' FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT k, 'either' FROM (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer)",
    "dedupe_first": "SELECT host, page_id, url FROM (SELECT regexp_extract(url, '^(\\w+://[^/]+)', 1) AS host, page_id, url FROM pages) QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id) = 1",
    "resource_check": "SELECT page_id, 'name' AS rule FROM pages WHERE NOT regexp_matches(regexp_replace(url, '[^a-z0-9]+', '-', 'g'), '^[a-z0-9_-]+$') UNION ALL SELECT page_id, 'path' FROM pages WHERE url LIKE '/%' OR url LIKE '%..%' UNION ALL SELECT page_id, 'bytes' FROM pages WHERE strlen(html) < 2000",
    "grade_letters": f"SELECT {cuts_sql('l_quantity * 2')} AS grade, count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1",
}
ORACLE["phi_totals"] = f"WITH m AS ({_SCANS}), n AS (SELECT doc_id, count(*) AS n FROM m GROUP BY 1), a AS (SELECT count(*) AS total_files, count_if(text IS NOT NULL AND n IS NULL)::BIGINT AS clean_files, count(n) AS dirty_files, count_if(text IS NULL)::BIGINT AS failed_files, coalesce(sum(n), 0)::BIGINT AS total_matches FROM documents LEFT JOIN n USING (doc_id)) SELECT *, dirty_files = 0 AND failed_files = 0 AS passed FROM a"
_TOLD = " UNION ALL ".join(f"SELECT {i} AS i, '{text}' AS advice WHERE EXISTS (SELECT 1 FROM found WHERE f AND category = '{c}')" for i, (c, text) in enumerate(privacy.ADVICE.items()))
ORACLE["hipaa_recommendations"] = f"WITH {_TAGGED}, s AS (SELECT * FROM ({ORACLE['hipaa_score']})), told AS ({_TOLD} UNION ALL SELECT 8, printf('{privacy.HIGH_RISK}', n_high) FROM s WHERE n_high > 0 UNION ALL SELECT 9, '{privacy.LITTLE_FOUND}' FROM s WHERE score >= 90) SELECT row_number() OVER (ORDER BY i) - 1 AS place, advice FROM told"
ORACLE["study_validation"] = f"""WITH m AS ({_SCANS}), n AS (SELECT doc_id, count(*) AS n FROM m GROUP BY 1),
d AS (SELECT source, text IS NOT NULL AS ok, CASE WHEN length(text) >= 3 THEN coalesce(n, 0) ELSE 0 END AS a, CASE WHEN text IS NOT NULL AND documents.doc_id % 50 = 0 THEN 1 ELSE 0 END AS b, CASE WHEN length(text) % 97 = 0 THEN 1 ELSE 0 END AS c FROM documents LEFT JOIN n ON documents.doc_id = n.doc_id),
s AS (SELECT source, count(*) AS files, count_if(ok)::BIGINT AS whole, count_if(a > 0)::BIGINT AS da, sum(a)::BIGINT AS fa, sum(b)::BIGINT AS db, sum(c)::BIGINT AS dc FROM d GROUP BY 1),
r AS (SELECT 1 AS i, source, 'identifiers' AS validator, whole AS checked, da AS dirty, fa AS found FROM s UNION ALL SELECT 2, source, 'private_tags', whole, db, db FROM s
UNION ALL SELECT 3, source, 'burned_in_text', whole, dc, dc FROM s UNION ALL SELECT 4, source, 'readable', files, files - whole, files - whole FROM s),
v AS (SELECT source, bool_and(dirty = 0) AS study_passed, coalesce(string_agg(CASE WHEN dirty > 0 THEN validator || ': ' || dirty || ' of ' || checked || ' files, ' || found || ' found' END, '; ' ORDER BY i), '') AS failures FROM r GROUP BY 1)
SELECT r.source, validator, dirty = 0 AS passed, false AS skipped, checked, dirty, found, study_passed, failures FROM r JOIN v ON r.source IS NOT DISTINCT FROM v.source"""

_SWEPT = f"""{_STEPS}, swept AS (SELECT s.doc_id, d.source, d.lang, CASE WHEN length(d.text) >= 4 AND t{len(_ALL_SCRUB)} <> d.text THEN trim(regexp_replace(t{len(_ALL_SCRUB)}, '\\s{{2,}}', ' ', 'g')) ELSE d.text END AS text, d.text AS was FROM s{len(_ALL_SCRUB)} s JOIN documents d ON s.doc_id = d.doc_id)"""
_LATER = "CASE WHEN doc_id % 41 = 40 THEN 'not_reached' ELSE"
_SEEN = f"""{_SWEPT}, hit AS ({" UNION ALL ".join(f"SELECT doc_id, len({_found_sql(k, p)}) AS n FROM swept WHERE length(text) >= 3" for k, p in privacy.SCAN.items())}), hits AS (SELECT doc_id, sum(n)::BIGINT AS n FROM hit GROUP BY 1),
seen AS (SELECT swept.*, swept.doc_id % 41 <> 40 AS whole, coalesce(n, 0) AS n, CASE WHEN swept.doc_id % 3 > 0 THEN swept.doc_id % 7 > 0 END AS defaced, swept.doc_id % 97 = 0 AS burned, '{privacy.UID_ROOT}' || CAST({_UID.replace('o_orderkey', 'swept.doc_id')} AS VARCHAR) AS uid FROM swept LEFT JOIN hits ON swept.doc_id = hits.doc_id),
told AS (SELECT *, CASE WHEN whole THEN 'done' ELSE 'failed' END AS s1, {_LATER} CASE WHEN defaced IS NULL THEN 'skipped' WHEN defaced THEN 'done' ELSE 'failed' END END AS s2, {_LATER} 'done' END AS s3, {_LATER} CASE WHEN n = 0 AND NOT burned THEN 'done' ELSE 'failed' END END AS s5,
 whole AND n = 0 AND NOT burned AND coalesce(defaced, true) AS ok, CASE WHEN whole THEN n END AS identifiers,
 CASE WHEN whole THEN sha256('PatientName=0:' || chr(10) || 'Remarks=' || coalesce(length(text) || ':' || text, 'null') || chr(10) || 'SeriesInstanceUID=' || length(substr(uid, 1, 64)) || ':' || substr(uid, 1, 64)) END AS sha FROM seen)"""
_RELEASED = f"WITH {_SEEN}"
ORACLE["release_files"] = f"{_RELEASED} SELECT CAST(doc_id AS VARCHAR) AS doc_id, ok, identifiers, sha AS sha256, concat_ws('|', s1, s2, s3, s3, s5) AS outcomes FROM told"
_OF = lambda s, i: f"SELECT source, '{s}' AS stage, {', '.join(f'count_if(s{i} = {chr(39)}{o}{chr(39)})::BIGINT AS {o}' for o in release.OUTCOMES)}, bool_and(ok) AS released FROM told GROUP BY source"
ORACLE["release_stages"] = f"{_RELEASED} {' UNION ALL '.join(_OF(s, i) for s, i in zip(release.STAGES, (1, 2, 3, 3, 5), strict=True))} UNION ALL SELECT source, 'export', CASE WHEN bool_and(ok) THEN count(*) ELSE 0 END, 0, 0, CASE WHEN bool_and(ok) THEN 0 ELSE count(*) END, bool_and(ok) FROM told GROUP BY source"
ORACLE["release_custody"] = f"""{_RELEASED} SELECT source, count(*) AS output_file_count, bool_and(s2 = 'done') AS defacing_applied, bool_and(ok) AS validation_passed, 0::BIGINT AS tags_removed, count_if(whole AND lang IS DISTINCT FROM '')::BIGINT AS tags_blanked, count_if(whole)::BIGINT AS uids_replaced, 0::BIGINT AS dates_shifted, count_if(whole AND text IS DISTINCT FROM was)::BIGINT AS text_scrubbed, count_if(whole AND doc_id % 50 = 0)::BIGINT AS private_stripped,
CAST(ceil(count(*) / 1000.0::DOUBLE) AS BIGINT) AS parts, printf('%x', bit_xor(CAST('0x' || substr(sha256(concat_ws(' ', doc_id, sha)), 1, 15) AS BIGINT))) AS fingerprint, substr(sha256(coalesce(source, '')), 1, 16) AS source_archive_id FROM told GROUP BY source"""
