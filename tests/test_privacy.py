"""De-identification of tags that no list names."""

import random
import re

from pyspark.sql import functions as F

from radspan.operators import privacy


def test_sweep_of_unlisted_tags(spark):
    given = {"ImageComments": "Aadhaar 1234 5678 9012", "PerformedProcedureStepDescription": "seen by Dr. Asha Rao  today", "StationName": "two  spaces", "DeviceSerialNumber": "ABCDE1234F", "(7fe0,0010)": "ABCDE1234F", "Short": "das", "Nothing": None, "(0009,0010)": "Sharma", "StudyID": "J1234567", "StudyDate": "20240229", "PatientID": "1.2.3"}
    df = spark.createDataFrame([(1, given), (2, {})], "k int, t map<string,string>")
    rows = privacy.deidentified(df, "t", F.col("k"), "s", [], [], ["PatientID"], ["StudyDate"], [])
    t, none = (r.t for r in rows.orderBy("k").collect())
    assert none == {} and set(t) == set(given) - {"(0009,0010)"}
    assert t["ImageComments"] == "Aadhaar" and t["PerformedProcedureStepDescription"] == "seen by today" and t["StudyID"] == ""
    for same in ("StationName", "DeviceSerialNumber", "(7fe0,0010)", "Short", "Nothing"):
        assert t[same] == given[same]
    assert t["PatientID"].startswith(privacy.UID_ROOT) and len(t["PatientID"]) > 40 and len(t["StudyDate"]) == 8


def test_verified_clean(spark):
    tags = [{"A": "x", "C": "y"}, {"A": " ", "B": None, "C": "y"}, {"B": "x"}, {"(0009,0010)": ""}, {"(0010,0010)": "x"}, {}]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "k int, t map<string,string>")
    got = df.select("k", privacy.verified_clean(F.col("t"), ["A"], ["B"]).alias("ok"), privacy.verified_clean(F.col("t"), [], []).alias("any"))
    assert [(r.ok, r.any) for r in got.orderBy("k").collect()] == [(False, True), (True, True), (False, True), (False, False), (True, True), (True, True)]
    clean = privacy.deidentified(df, "t", F.col("k"), "s", ["A"], ["B"], [], [], [])
    assert clean.where(privacy.verified_clean(F.col("t"), ["A"], ["B"])).count() == len(tags)


def test_tries_and_guards_change_no_match(spark):
    """A trie of words finds what the list finds; guarded patterns find what each finds alone."""
    rng = random.Random(5)
    for p in (privacy.SCAN["surname_indian"], privacy.SCRUB["indian_surname"], r"\b(?:Sin|Sinha|Singh|Sin)\b"):
        assert privacy.quick(p) != p
        words = re.findall(r"[A-Za-z']+", p[p.index("(?:") + 3 :])
        for _ in range(300):
            text = "".join(rng.choice([*words, " ", " ", "-", "'", "s", "_", "1", "SHAH"]) for _ in range(12))
            assert [m.group(0) for m in re.finditer(privacy.quick(p), text, re.A)] == [m.group(0) for m in re.finditer(p, text, re.A)]
    for same in (privacy.SCAN["ssn"], r"\b(?:O|O'Neil)\b", r"\b(?:Kumari?|Sri)\b"):
        assert privacy.quick(same) == same
    pieces = ["123-45-6789", "a.b@c.org", "@", "Rao", "Dr. Asha Rao", "March 3, 2024", "www.x.org", " ", " ", "IST", "10:15", "ABC1234567", "City Hospital", "0123456789abcdef0123", "abcdefabcdefabcdefabcd"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))) for i in range(200)] + [(200, None)]
    every = privacy.SCAN | privacy.EXTENDED
    df = spark.createDataFrame(rows, "k int, t string")
    got = {r.k: (r.n, sorted(map(tuple, r.m or [])), r.s) for r in df.select("k", privacy.match_count(F.col("t"), every).alias("n"), privacy.matches(F.col("t"), every).alias("m"), privacy.scrub(F.col("t")).alias("s")).collect()}
    for k, t in rows:
        found = sorted((n, m.group(0)) for n, p in every.items() for m in re.finditer(p, t or ""))
        left = t
        for p in privacy.SCRUB.values():
            left = left and re.sub(p, "", left)
        assert got[k][1:] == (found, None if t is None else re.sub(r"\s{2,}", " ", left).strip())
        assert t is None or got[k][0] == len(found)
