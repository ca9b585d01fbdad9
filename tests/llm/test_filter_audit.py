"""The lattice against a walk of every order over every document, and the query's SQL over the given tables."""

from itertools import permutations

import duckdb
import pytest

from radspan.llm import filter_audit, queries


def _brute(rows, labels):
    """rows: (id, part, text). The definition, document by document."""
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs = []
    for i, part, t in rows:
        t = t or ""
        words = [w for w in t.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t)}
        fails |= {"D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        docs.append((part or "", {f for f, x in fails.items() if x}, *labels.get(i, (False, False))))
    out = {}
    for part in {d[0] for d in docs}:
        own, shapley = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                redundant = sum(f in d[1] for d in own) - len(gone)
                out[part, "".join(order), step] = (len(left), len(gone), redundant, sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone))
        for (p, order, step), x in list(out.items()):
            if p == part:
                out[p, order, step] = (*x[:6], shapley[order[step - 1]])
    return out


def test_every_order_of_odd_rows(spark, docs):
    long = " ".join(f"w{i}" for i in range(250))
    more = [(100, long, None, "s1", None), (101, long, None, "s1", None), (101, long, None, "s1", None), (102, long + " $", None, "s2", None), (103, "A B " * 150, None, "s2", None), (None, long, None, "s1", None)]
    df = docs.unionByName(spark.createDataFrame([(*r, "x", None, 1, 2, 3, 4, 5) for r in more], docs.schema))
    labels = spark.createDataFrame([(8, 1, 0), (100, 1, 1), (101, 0, 1), (101, 1, None), (None, 1, 1), (103, None, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.failures(df, labels)).collect()
    known = {8: (True, False), 100: (True, True), 101: (True, True), 103: (False, True)}
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == _brute([(r.doc_id, r.source, r.text) for r in df.collect()], known)
    assert len(got) == 600 * len({r.source for r in df.collect()})


def test_other_numbers_of_filters(spark):
    rows = spark.createDataFrame([("p", 3, True, False)] * 5 + [("p", 0, False, False)] * 2 + [("p", 2, False, True)], "part string, mask int, good boolean, toxic boolean")
    got = {(r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(rows, "AB").collect()}
    assert got == {("AB", 1): (3, 5, 0, 0, 5, 0, 5), ("AB", 2): (2, 1, 5, 1, 0, 1, 7), ("BA", 1): (2, 6, 0, 1, 5, 1, 7), ("BA", 2): (2, 0, 5, 0, 0, 0, 5)}
    assert filter_audit.edges(rows, "AB").count() == 4


def test_a_lattice_has_eighty_edges_and_six_hundred_steps(spark):
    rows = spark.createDataFrame([("p", 0, False, False)], "part string, mask int, good boolean, toxic boolean")
    assert filter_audit.edges(rows).count() == 80 and filter_audit.steps(spark).count() == 600


def test_measures_do_not_hang_on_portions(monkeypatch):
    from radspan.llm import shingles

    texts = [b"Ab cd\tAb\ncd ef" * 50, "é Ü x ".encode() * 300, b"", b" ", b"#"]
    whole = [filter_audit.mask_of(t) for t in texts]
    monkeypatch.setattr(shingles, "PORTION", 16)
    assert [filter_audit.mask_of(t) for t in texts] == whole


def test_empty_tables(spark, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(empty_docs, none)).isEmpty()


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_and_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()["op11_filter_audit"])
    got = queries.op11_filter_audit(spark, d)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
