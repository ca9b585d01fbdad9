"""Edges that the driver's tables do not have: nulls, ties, thresholds, empty tables."""

import hashlib
import warnings
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from radspan.functions import classify, scoring, text
from radspan.operators import cohorts, consensus, integrity, manifest, privacy, profile, splits, volume


def values(df, column):
    return [r[column] for r in df.collect()]


SERIES = "study_id string, sequence_type string, file_count long, quality_grade string, ml_score double"


@pytest.fixture(scope="module")
def series(spark):
    rows = [("a", "DWI", 3, "A", 80.0), ("a", "ADC Map", None, "B", None), ("a", None, 2, None, 60.0), ("b", "T1-weighted", None, "C", None), ("b", "SWI (SWAN)", None, "B", None), ("c", None, None, None, None)]
    return spark.createDataFrame(rows, SERIES)


def test_rollup_nulls_and_ties(series):
    got = {r.study_id: r for r in manifest.study_rollup(series).collect()}
    assert got["a"].sequences_present == ["ADC Map", "DWI"] and got["a"].total_files == 5 and got["a"].mean_ml_score == 70
    assert got["a"].dominant_grade == "A" and got["b"].dominant_grade == "B"
    assert got["b"].has_swan and got["b"].has_t1 and not got["b"].has_dwi
    assert got["c"].dominant_grade is None and got["c"].total_files is None and got["c"].sequences_present == [] and not got["c"].has_t2
    assert manifest.study_rollup(series.limit(0)).count() == 0


def test_confidence(spark):
    rows = [("a", 0.9, False, False), ("a", 0.4, True, True), ("a", None, True, True)]
    r = manifest.confidence_rollup(spark.createDataFrame(rows, "s string, confidence double, needs_escalation boolean, premium_used boolean"), ["s"]).first()
    assert (r.n_series, round(r.mean_confidence, 6), r.pct_low_confidence, r.n_needs_escalation, r.pct_premium_used) == (2, 0.65, 0.5, 1, 0.5)


def test_cohorts(series, spark):
    assert values(cohorts.sequence_contains(series, "dwi"), "sequence_type") == ["DWI"]
    assert cohorts.swan_only(series).count() == 1
    assert cohorts.grade_at_least(series, "B").count() == 3
    with pytest.raises(ValueError, match="unknown"):
        cohorts.grade_at_least(series, "E")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert cohorts.sequence_contains(series.drop("sequence_type"), "x").count() == 0
        assert cohorts.single_vendor(series, "x").count() == series.count()
        assert cohorts.grade_at_least(series.drop("quality_grade"), "A").count() == series.count()
    assert len(seen) == 3
    assert set(values(cohorts.complete_protocol_series(series, ["dwi", "adc"]), "study_id")) == {"a"}
    assert set(values(cohorts.with_both(series, "DWI", "ADC Map"), "study_id")) == {"a"}
    listed = spark.createDataFrame([("x", ["DWI", "T1"]), ("y", []), ("z", None)], "study_id string, sequences_present array<string>")
    assert values(cohorts.complete_protocol_studies(listed, ["dwi"]), "study_id") == ["x"]
    fields = spark.createDataFrame([(1.5,), (1.549,), (3.0,), (None,)], "field_strength_T double")
    assert cohorts.single_field(fields, 1.5).count() == 2


@pytest.mark.parametrize("n", [10, 100, 400])
def test_splits(spark, n):
    rows = [(f"s{i}", "ABCD"[i * 7 % 4], None if i % 50 == 0 else "GE") for i in range(n)]
    df = spark.createDataFrame(rows, "study_id string, dominant_grade string, vendor string")
    got = splits.assign(df, (0.7, 0.15, 0.15), 1, ["dominant_grade"]).collect()
    assert len(got) == n and len({r.study_id for r in got}) == n
    assert sorted(got) == sorted(splits.assign(df.repartition(3), (0.7, 0.15, 0.15), 1, ["dominant_grade"]).collect())
    if n >= 100:
        share = sum(r.split == "train" for r in got) / n
        assert abs(share - 0.7) <= 0.05
        assert {r.study_id for r in got if r.split == "test"} != {r.study_id for r in splits.assign(df, (0.7, 0.15, 0.15), 2).collect() if r.split == "test"}


def test_split_edges(spark):
    df = spark.createDataFrame([("a", "A"), ("b", None), ("c", "B")], "study_id string, g string")
    assert values(splits.stratum(df, ["g"]), "_stratum") == ["__other__"] * 3
    for bad in ((0.5, 0.5, 0.5), (1.0, 0.0, 0.0), (0.5, 0.5)):
        with pytest.raises(ValueError, match="ratios"):
            splits.assign(df, bad)
    with pytest.warns(UserWarning, match="unchanged"):
        assert splits.assign(df.withColumn("split", F.lit("x"))).count() == 3
    with pytest.warns(UserWarning, match="not stratified"):
        assert splits.assign(df, stratify=["nothing"]).count() == 3
    assert splits.assign(df.limit(0), stratify=["g"]).columns[-1] == "split"


NAMED = [("3D Ax T2 Cube", "CUBE (3D FSE)"), ("Ax T2 FLAIR", "FLAIR"), ("eADC[No-Q]", "ADC Map"), ("SE T1_3D", "T1-weighted"), ("WIP SE 3D_T1", "3D T1-weighted"), ("B-FFE", "Balanced FFE (bSSFP)"), ("loc", "Survey/Localizer"), ("t2w", "T2-weighted"), ("Nothing", "Unknown"), (None, "Unknown")]
TIMED = [(None, None, 1801.0, None, "FLAIR"), (None, None, 1800.0, None, "FLAIR (probable)"), (None, None, 1200.0, None, "Unknown"), (None, None, 299.0, None, "STIR"), (2999.0, None, 500.0, None, "T1-weighted (IR)"), (3000.0, None, 500.0, None, "Unknown"), (4001.0, 81.0, None, None, "T2-weighted"), (4001.0, 29.0, None, None, "Proton Density"), (2001.0, 81.0, None, None, "T2-weighted"), (799.0, 29.0, None, None, "T1-weighted"), (None, None, None, 5.0, "DWI"), (None, None, None, 0.0, "Unknown")]


def test_classifier(spark):
    rows = [(d, None, None, None, None, None) for d, _ in NAMED] + [("x", tr, te, ti, 90.0, b) for tr, te, ti, b, _ in TIMED] + [("DWI", None, None, None, None, 0.0), ("DTI", None, None, None, None, 1000.0)]
    df = spark.createDataFrame(rows, "d string, tr double, te double, ti double, fa double, b double")
    got = classify.with_sequence(df, "d", "tr", "te", "ti", "fa", "b").collect()
    assert [r.sequence_type for r in got] == [t for _, t in NAMED] + [t for *_, t in TIMED] + ["DWI (b=0)", "DTI"]
    assert [r.confidence for r in got[:2]] == ["high", "high"] and got[len(NAMED)].confidence == "high" and got[len(NAMED) + 1].confidence == "medium"
    assert got[-1].reasons[-1] == "b-value=1000.0 confirms diffusion weighting" and got[-1].parameters.b_value == 1000


def test_letters(spark):
    df = spark.createDataFrame([(x,) for x in (80.0, 79.999, 65.0, 50.0, 35.0, 34.999)], "s double")
    assert values(df.select(scoring.letter(F.col("s")).alias("g")), "g") == list("ABBCDF")
    assert values(df.select(scoring.tier(F.col("s")).alias("g")), "g") == ["premium", "standard", "standard", "discount", "exclude", "exclude"]


def test_series_score(spark):
    df = spark.createDataFrame([(20.0, None, 1.2, 60.0, 500.0, 5.0, 50.0, "T1"), (None,) * 7 + (None,)], "a double, b double, c double, d double, e double, f double, g double, n string")
    got = values(df.select(scoring.total(scoring.series_parts(*[F.col(c) for c in "abcdefg"], F.col("n"))).alias("s")), "s")
    assert got == [100.0, 0.0]


def test_names(spark):
    df = spark.createDataFrame([("Ax SCORE",), ("max",), (None,), ("Été-1/x",), ("***",), ("sub-9_ses-2",)], "d string")
    assert values(df.select(text.plane(F.col("d")).alias("x")), "x")[:3] == ["coronal", "axial", None]
    assert values(df.select(text.safe_name(F.col("d")).alias("x")), "x")[3] == "Été-1_x"
    assert values(df.select(text.safe_label(F.col("d")).alias("x")), "x")[4] == "unknown"
    parts = df.select(*[c.alias(n) for c, n in zip(text.study_parts(F.col("d")), "ab", strict=True)]).collect()
    assert tuple(parts[5]) == ("9", "2") and tuple(parts[1]) == ("max", "01")
    sizes = spark.createDataFrame([(5,), (2048,), (3 << 20,)], "n long")
    assert values(sizes.select(text.human_size(F.col("n")).alias("x")), "x") == ["5 B", "2.0 KB", "3.0 MB"]


def test_json_replies(spark):
    replies = ['{"a": 1}', 'x ```json\n{"a": 2}\n``` y', 'I say {"a": 3}.', "[error: {}]", "", None, "[1]", "{bad"]
    df = spark.createDataFrame([(r,) for r in replies], "r string")
    assert values(df.select(F.get_json_object(text.json_object(F.col("r")), "$.a").alias("a")), "a") == ["1", "2", "3", None, None, None, None, None]


SAMPLES = {"ssn": "123-45-6789", "phone_us": "555-123-4567", "aadhaar": "1234 5678 9012", "pan": "ABCDE1234F", "voter_id": "ABC1234567", "driving_license": "MH-1234567890", "passport": "J1234567", "uhid": "mrn: 12345", "phone_india": "+91 9876543210", "phone_landline": "022-12345678", "name_indian": "Dr. Asha Rao", "surname_indian": "sharma", "email": "a.b@c.org", "url": "www.x.org/y", "institution": "City Hospital", "date_text": "1/2/2024", "date_named": "March 3, 2024", "timestamp_ist": "10:15 IST", "mrn_like": "AB123456"}


def test_scan_patterns(spark):
    df = spark.createDataFrame([(k, f"é {v} é") for k, v in SAMPLES.items()] + [("none", "ab"), ("null", None)], "k string, t string")
    found = {(r.k, r.pattern): r.match for r in privacy.scan(df, "k", "t").collect()}
    for k, v in SAMPLES.items():
        assert v in found[(k, k)] or found[(k, k)] in v
    assert not [x for x in found if x[0] in ("none", "null")]


def test_scrub_is_stable(spark):
    df = spark.createDataFrame([(f"See  {v} here",) for v in SAMPLES.values()], "t string")
    once = df.select(privacy.scrub(F.col("t")).alias("t"))
    assert values(once.select(privacy.scrub(F.col("t")).alias("t")), "t") == values(once, "t")
    by = privacy.scrub_with_names(spark.createDataFrame([("mail a@b.co on 01/02/2024",)], "t string"), "t").first()
    assert by.scrubbed == "mail on" and by.scrubbed_by == ["email", "date_slash"]


def test_pseudonyms_and_dates(spark):
    r = spark.createDataFrame([("1.2.3",)], "u string").select(privacy.pseudonym(F.col("u"), "s").alias("p"), privacy.shift_days(F.col("u")).alias("d")).first()
    h = hashlib.sha256(b"s1.2.3").hexdigest()
    assert r.p == f"{privacy.UID_ROOT}{int(h[:24], 16)}"[:64]
    days = -365 + int.from_bytes(hashlib.sha256(b"1.2.3").digest()[:4], "big") % 336
    assert r.d == days
    given = ["20240229", "20241340", "2024", "", "20240101123000.123", None]
    got = values(spark.createDataFrame([(g,) for g in given], "d string").select(privacy.shift_date(F.col("d"), F.lit(days)).alias("x")), "x")
    moved = (datetime(2024, 2, 29) + timedelta(days)).strftime("%Y%m%d")
    assert got[:4] == [moved, "", "2024", ""] and got[4].endswith("123000.123")


def test_tags(spark):
    tags = [{"PatientName": "x", "PatientID": "0", "Country": "IN", "(0009,0010)": "p", "PatientComments": "call 555-123-4567"}, {"PatientName": "None"}, {}]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "k int, t map<string,string>")
    risk = {r.k: (r.n_found, r.n_empty, r.risk) for r in privacy.file_risk(privacy.inventory(df, "k", "t"), "k").collect()}
    assert risk == {0: (3, 2, "high"), 1: (0, 1, "none")}
    assert privacy.conformance(df, "k", "t", ["PatientName", "Country"]).count() == 2
    assert [tuple(r)[:2] for r in privacy.private_tags(df, "k", "t").collect()] == [(0, 1)]
    clean = privacy.deidentified(df, "t", F.col("k"), "s", ["Country"], ["PatientName"], ["PatientID"], [], ["PatientComments"]).first().t
    assert set(clean) == {"PatientName", "PatientID", "PatientComments"} and clean["PatientName"] == "" and clean["PatientComments"] == "call"


def test_consensus(spark):
    votes = [("s", "T1", True, "A", "cheap"), ("s", "T2", False, None, "premium"), ("t", "T1", None, "B", "cheap"), ("t", "T1", False, "C", "cheap"), ("u", "X", True, "?", None)]
    got = {r.k: r for r in consensus.consensus(spark.createDataFrame(votes, "k string, s string, f boolean, g string, tier string"), "k", "s", "f", "g", "tier").collect()}
    assert got["s"].s == "T1" and got["s"].agreement == 0.5 and got["s"].found and got["s"].needs_escalation and got["s"].premium_used
    assert got["s"].disagreements == ["sequence_type", "pathology_found"] and got["t"].quality_grade == "C" and got["u"].quality_grade == "F"
    assert got["t"].confidence == 1.0 and not got["t"].needs_escalation


def test_route_and_cost(spark):
    tries = [("a", 1, "low", "r", 1.0), ("a", 2, "high", "r", 2.0), ("a", 3, None, "r", 4.0), ("b", 1, None, None, 1.0), ("b", 2, "LOW", "r", 2.0), ("c", 1, None, "r", 1.0)]
    df = spark.createDataFrame(tries, "k string, o int, conf string, reply string, c double")
    got = {r.k: (r.winner, r.misses, r.cost) for r in consensus.route(df, "k", "o", cohorts.acceptable(F.col("conf"), F.col("reply")), F.col("c")).collect()}
    assert got == {"a": (2, 1, 3.0), "b": (None, 2, 3.0), "c": (1, 0, 1.0)}
    policy = spark.createDataFrame([(1, "x", 0.5, 1.0), (2, "y", 0.9, 2.0), (3, "z", 0.1, 3.0)], "ord int, model string, hit_rate double, cost_per_call double")
    assert [round(c, 9) for c in values(consensus.corpus_cost(policy, 100), "calls")] == [100, 50, 5]
    calls = spark.createDataFrame([("x", 4500, 1500), ("new", 1, 1)], "m string, i int, o int")
    prices = spark.createDataFrame([("x", 1.0, 2.0)], "model string, price_in double, price_out double")
    assert values(consensus.call_cost(calls, prices, "m", "i", "o"), "cost") == [0.0075, 0.0]


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (10.0, "a"), (None, "b"), (4.0, None)], "x double, s string")
    p = {r.column: r for r in profile.column_profile(df).collect()}
    assert p["x"].nulls == 1 and p["x"].n_unique == 5 and p["s"].null_pct == 20
    r = profile.numeric_profile(df, ["x"]).first()
    assert (r.min, r.max, r.median, r.p25, r.p75) == (1, 10, 3, 2, 4) and round(r.std, 6) == round(float(np.std([1, 2, 10, 4], ddof=1)), 6)
    assert tuple(profile.string_profile(df, ["s"]).first())[1:] == (2, "a", 2, 1.0)


def test_integrity(spark):
    was = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "p string, sha256 string")
    now = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "p string, sha256 string")
    assert sorted(map(tuple, integrity.verify(was, now, "p").collect())) == [("b", "mismatch"), ("c", "missing")]
    assert "a --> b" in integrity.stage_graph([("a", "A"), ("b", "B")])
    rows = spark.createDataFrame([("10",), ("9",), ("x",), ("2",)], "n string")
    assert values(integrity.place(rows.withColumn("k", F.lit(1)), ["k"], integrity.numbered_first("n")).orderBy("place"), "n") == ["2", "9", "10", "x"]
    badge = spark.createDataFrame([("A",)], "g string").select(integrity.badge_svg(F.col("g")).alias("b")).first().b
    assert badge.startswith("<svg") and "grade A" in badge


def test_volume_expressions(spark):
    rng = np.random.default_rng(1)
    arrays = [rng.normal(size=64).tolist(), [3.0] * 64, list(map(float, range(64)))]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "k int, v array<double>")
    counts = values(volume.with_histogram(df, "v", 8).orderBy("k"), "counts")
    assert counts == [np.histogram(a, 8)[0].tolist() for a in arrays]
    p = values(df.orderBy("k").select(volume.percentile(F.col("v"), 0.3).alias("p")), "p")
    assert np.allclose(p, [np.percentile(a, 30) for a in arrays])
    half = values(volume.halved(df, "k", "v", 4).orderBy("k"), "v")
    assert np.allclose(half[0], np.reshape(arrays[0], (2, 2, 2, 2, 2, 2)).mean((1, 3, 5)).ravel())
    odd = spark.createDataFrame([(0, [float(i) for i in range(27)])], "k int, v array<double>")
    want = np.pad(np.arange(27.0).reshape(3, 3, 3), ((0, 1),) * 3).reshape(2, 2, 2, 2, 2, 2).mean((1, 3, 5))
    assert np.allclose(volume.halved(odd, "k", "v", 3).first().v, want.ravel())
    affine = spark.createDataFrame([([[2.0, 0.0, 0.0], [0.0, 3.0, 0.0], [0.0, 0.0, -4.0]],)], "a array<array<double>>")
    assert affine.select(volume.voxel_volume(F.col("a")).alias("x")).first().x == 24


def test_volume_metrics(spark):
    rng = np.random.default_rng(2)
    half = rng.random((8, 32, 16)) * 100 + 1
    mirrored = np.concatenate([half, half[..., ::-1]], axis=-1)
    noise = rng.random((8, 32, 32)) * 100 + 1
    rows = [(0, mirrored.ravel().tolist()), (1, noise.ravel().tolist()), (2, [1.0]), (3, None), (4, np.zeros(8 * 32 * 32).tolist())]
    got = {r.k: r for r in volume.with_metrics(spark.createDataFrame(rows, "k int, v array<double>"), "k", "v", (8, 32, 32)).collect()}
    assert got[0].symmetry_index > 0.999 and got[0].symmetry == "symmetric" and got[1].symmetry_index < 0.2
    assert got[2].symmetry_index is None and got[3].n_peaks is None
    assert got[4].cnr == 0 and got[4].noise_floor == 0 and got[4].n_peaks == 0 and got[4].mean_correlation == 1
    assert got[1].cnr > 1 and not got[0].motion
