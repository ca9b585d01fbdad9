"""The registered scan and scrubber hold every pattern: against Python's re and against their SQL."""

import hashlib
import re

import duckdb
import pytest

from radspan import registry
from radspan.operators import privacy

TEXTS = [
    "123-45-6789 and 555-123-4567, Aadhaar 1234 5678 9012, PAN ABCDE1234F",
    "voter ABC1234567 licence MH-1234567890 passport J1234567 mrn: 12345",
    "+91 9876543210 or +91-9876543210,+919876543210;09876543210 not 109876543210 nor +91 98765432101 nor 1+919876543210",
    "022-12345678  seen by Dr. Asha Rao and Prof Anil Bose Sen at City Hospital",
    "sharma D'Souza a.b@c.org www.x.org/y https://x.org/?a=1 on 1/2/2024, 01/02/2024, 1-2-24",
    "March 3, 2024 at 10:15 IST, 2024-03-03T10:15:00, AB123456 and acc ABCD1234567",
    "card 1234 5678 9012 3456 from 10.0.0.1, +1 (743) 555-3824, 0123456789abcdef0123",
    "no finding  here",
    "ab",
    "",
    None,
]


def _tables(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    return con


def _same_as_sql(con, name, got):
    assert sorted(map(str, got)) == sorted(map(str, con.sql(registry.oracle_sql()[name]).fetchall()))


def test_phi_scan_documents(spark, tmp_path):
    con = _tables(spark, tmp_path)
    want = []
    for i, t in enumerate(TEXTS):
        for name, p in (privacy.SCAN | privacy.EXTENDED).items():
            found = [m.group(0) for m in re.finditer(p, t or "")]
            if found and len(t) >= 3:
                want.append((i, name, len(found), min(found)))
    assert {w[1] for w in want} == set(privacy.SCAN | privacy.EXTENDED)
    got = [tuple(r) for r in registry.queries()["phi_scan_documents"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
    _same_as_sql(con, "phi_scan_documents", got)


def test_text_scrub_all(spark, tmp_path):
    con, want, used = _tables(spark, tmp_path), [], set()
    for i, t in enumerate(TEXTS):
        by = []
        for name, p in (privacy.EXTENDED | privacy.SCRUB).items():
            left = re.sub(p, "", t or "")
            by += [name] if left != (t or "") else []
            t = t and left
        used |= set(by)
        want.append((i, None if t is None else hashlib.md5(re.sub(r"\s{2,}", " ", t).strip().encode()).hexdigest(), "|".join(by)))
    assert set(privacy.SCRUB) - used <= {"physician", "date_dash", "voter_id"}  # eaten by earlier patterns of the order
    got = [tuple(r) for r in registry.queries()["text_scrub_all"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
    _same_as_sql(con, "text_scrub_all", got)


ODD = ["das\u00e4t \u00fcDas das\u0301 das_ das1 \u00e9 das", "\u00e4123-45-6789\u00e4 x@y.org\u00e9 \u00fc.a@b.cd", "\u00fcDr. Anna\u00e4 AB1234567\u00df 12:30 UTC\u00e4", "1.2.3.4\u00e9 \u0660das \u00e4\u00e4www.x.y Kumar\u00e4"]


@pytest.mark.parametrize("name", ["phi_scan_documents", "text_scrub_all", "phi_regex_scan", "text_scrub"])
def test_words_end_at_letters_of_other_scripts(spark, tmp_path, name):
    rows = [(i, t) for i, t in enumerate(ODD)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    _same_as_sql(con, name, [tuple(r) for r in registry.queries()[name](spark, str(tmp_path)).collect()])


def test_a_pattern_of_the_caller_has_ascii_words_too():
    assert privacy.java(r"\bx?-\b") == f"{privacy._ENDS}x?-{privacy._ENDS}"
    assert privacy.java(r"\\b\d") == r"\\b\d"
