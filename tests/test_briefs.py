"""Safe values, briefs, citation records and cost lines on values given by hand."""

import json

from pyspark.sql import functions as F

from radspan.functions import briefs


def test_safe_and_split_values(spark):
    rows = [(b"\x01\xff", "bytes"), (b"\0" * 65, "bytes"), (b"", "bytes"), (b"3", "sequence"), ("é".encode(), "text"), (None, "bytes"), (None, "text")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v binary, k string").orderBy("i")
    assert [r[0] for r in df.select(briefs.safe_value(F.col("v"), F.col("k"))).collect()] == ["01ff", "[bytes: 65]", "", "[Sequence: 3 items]", "é", None, None]
    parts = spark.createDataFrame([(0, "1\\2.5", True), (1, "1\\x", True), (2, "1\\2", False), (3, None, True), (4, "1\\NaN", True), (5, "", None)], "i int, v string, n boolean").orderBy("i")
    assert [r[0] for r in parts.select(briefs.split_value(F.col("v"), F.col("n"))).collect()] == ["[1.0,2.5]", '["1","x"]', '["1","2"]', None, '["1","NaN"]', '[""]']


def test_brief(spark):
    names = "label string, error string, sequence string, agreement double, grade string, structures array<string>, found boolean, agreeing int, total int, findings array<string>, differential array<string>, notable array<string>, disputed array<string>"
    rows = [
        ("s1", None, "FLAIR", 0.625, "B", [f"x{i}" for i in range(13)], True, 2, 3, ["left • bright"], ["a", "b"], ["n"], ["sequence_type", "pathology_found"]),
        ("s2", None, None, None, None, None, None, None, None, ["never told"], None, [], []),
        ("s3", "no answers", "T1", 1.0, "A", [], True, 1, 1, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, names).orderBy("label")
    got = [r[0] for r in df.select(briefs.brief(*[F.col(c) for c in df.columns])).collect()]
    assert got[0].split("\n") == ["### s1", "- Sequence: **FLAIR** (agreement 62%)", "- Quality grade: **B**", "- Coverage: " + ", ".join(f"x{i}" for i in range(12)), "- **Pathology** (2/3 models):", "  - left • bright", "  - Differential: a; b", "- Notable: n", "- ⚠ Inter-model disagreement on: sequence_type, pathology_found"]
    assert got[1].split("\n") == ["### s2", "- Sequence: **?** (agreement 0%)", "- Quality grade: **?**", "- Pathology: none flagged by consensus"]
    assert got[2] == "### s3\n_no answers_"
    votes = F.create_map(F.lit("a"), F.lit(2))
    rec = df.select(briefs.disagreement_records([("sequence_type", F.col("agreement") < 1, votes), ("pathology_found", F.lit(None).cast("boolean"), votes)]).alias("d")).collect()
    assert [[(x.field, x.votes) for x in r.d] for r in rec] == [[("sequence_type", {"a": 2})], [], []]


def test_citation_and_costs(spark):
    one = spark.range(1)
    full = briefs.citation(F.lit("T"), F.array(F.lit("A")), F.lit("P"), F.lit(2026), F.lit("10.1/x"), F.array(F.lit("s")), F.lit("about"), F.lit("2020-01-01"), F.lit(None).cast("string"), F.array(F.lit("1 GB")), F.lit("1"))
    empty = briefs.citation(F.lit(" "), F.array().cast("array<string>"), F.lit(None).cast("string"), F.lit("26"), F.lit(None).cast("string"), F.lit(None).cast("array<string>"), F.lit(None).cast("string"), F.lit("a"), F.lit("b"), F.array(F.lit("")), F.lit("1"))
    r = one.select(full.alias("f"), empty.alias("e")).select(F.to_json("f").alias("j"), briefs.citation_gaps(F.col("f")).alias("a"), briefs.citation_gaps(F.col("e")).alias("b")).first()
    assert r.a == [] and r.b == ["identifiers", "creators", "titles", "publisher", "publicationYear", "subjects", "descriptions"]
    assert json.loads(r.j)["identifiers"] == [{"identifier": "https://doi.org/10.1/x", "identifierType": "DOI"}] and json.loads(r.j)["dates"][0]["date"] == "2020-01-01"
    df = spark.createDataFrame([(0, 1.25, None), (1, None, None), (2, 0.5, 0.25)], "i int, m double, c double").orderBy("i")
    assert [x[0] for x in df.select(briefs.cost_line("run", F.col("m"), F.col("c"))).collect()] == ["run: compute=$1.2500 calls=n/a total=$1.2500", "run: compute=n/a calls=n/a total=n/a", "run: compute=$0.5000 calls=$0.2500 total=$0.7500"]
