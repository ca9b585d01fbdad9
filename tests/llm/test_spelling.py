"""One-edit pairs, forms and roots against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from radspan.llm import spelling
from radspan.llm.common import work_table


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _grouped(n):
    form, count = {}, {}
    for w in n:
        near = [x for x in n if _near(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w], count[w] = best if best and n[best] >= 5 * n[w] else None, len(near)

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], count[w], n.get(form[w])) for w in n}


def _words(rows, damage):
    found = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= 6
    return {w: n for w, n in found.items() if n >= 5}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", max_size=6), unique=True, max_size=25))
def test_tries_give_all_pairs(words):
    want = {(i, j) for j in range(len(words)) for i in range(j) if _near(words[i], words[j])}
    assert spelling.one_edit(words) == want


def test_tries_of_runs_of_one_letter():
    words = ["a" * n for n in range(8)] + ["aab", "aba", "baa", "abab"]
    assert spelling.one_edit(words) == {(i, j) for j in range(len(words)) for i in range(j) if _near(words[i], words[j])}


@pytest.mark.parametrize("most", [2, 7, 4096])
def test_pairs_of_crowded_words(spark, most):
    """Few letters, so groups are far beyond `most` and halved until a character is left."""
    rng = random.Random(most)
    words = sorted({"".join(rng.choice("abÿ") for _ in range(rng.randint(6, 8))) for _ in range(300)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa"})
    n = {w: rng.choice((5, 6, 25, 30, 150)) for w in words}
    rows = work_table(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3), "w")
    pairs = spelling.near_pairs(rows, most).collect()
    assert sorted((r.a, r.b) for r in pairs) == sorted((a, b) for a in words for b in words if a < b and _near(a, b))
    assert all((n[r.a], n[r.b]) == (r.an, r.bn) for r in pairs)
    got = {r.word: tuple(r)[1:] for r in spelling.grouped(rows, most=most).collect()}
    assert got == _grouped(n)


def test_chains_of_forms_end_at_their_root(spark):
    chain, n = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"], 1
    rows = []
    for w in chain:
        rows.append((w, n))
        n *= 5
    got = {r.word: (r.form, r.root) for r in spelling.grouped(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got == {w: (chain[i + 1] if i < 5 else None, chain[5]) for i, w in enumerate(chain)}


def test_ties_go_to_the_first_word(spark):
    rows = [("planet", 5), ("planes", 50), ("planeé", 50), ("planed", 50)]
    got = {r.word: r.form for r in spelling.grouped(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["planet"] == "planed" and got["planed"] is None


@pytest.mark.parametrize("damage", [None, 2, 199])
def test_whole_tables(spark, docs, damage):
    rng = random.Random(4)
    pool = ["quality", "measure", "Étoile", "straßen", "letters"]
    rows = [(rng.choice((None, i)), " ".join(rng.choice(pool) for _ in range(40)) + "ΔQUALITY9measure") for i in range(12)] + [(1, "letters " * 3000)]
    more = [(*r, "en", "s1", None, "x", None, 1, 2, 3, 4, 5) for r in rows]
    df = docs.unionByName(spark.createDataFrame(more, docs.schema))
    got = {r.word: tuple(r)[1:] for r in spelling.group(df, damage).collect()}
    want = _grouped(_words([(r.doc_id, r.text) for r in df.collect()], damage))
    assert got == want and len(got) > 4


def test_empty_table(empty_docs):
    assert spelling.group(empty_docs).isEmpty()
