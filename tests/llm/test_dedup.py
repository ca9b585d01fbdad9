"""Exact and near duplicates, components, sharding and mixing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from radspan.llm import components, exact_dedup, mixing, near_dedup, shard
from radspan.llm.shingles import shingle_sets
from tests.llm.conftest import words


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def least(ids):
    return min(ids, key=lambda i: (i is not None, i or 0))


@pytest.mark.parametrize("support", [0.001, 0.05, 0.3])
def test_exact_dedup(docs, support):
    """One row of each group stays, also of rows that repeat an id and a text."""
    groups = defaultdict(list)
    for i, t in rows_of(docs):
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()].append((i, len(t or "")))
    want = []
    for sha, rows in groups.items():
        most = max(n for _, n in rows)
        keep = least([i for i, n in rows if n == most])
        want += [(i, keep, len(rows), sha) for i, _ in rows]
    got = exact_dedup.decide(docs, support=support).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got)
    assert sorted((r.text_sha256, str(r.doc_id)) for r in got if r.kept) == sorted({(sha, str(keep)) for _, keep, _, sha in want})


def winners(rows):
    """Of each group of equal texts an id and the length of the row that stays."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = {}
    for key, found in groups.items():
        most = max(len(t) for _, t in found)
        out[key] = (least([i for i, t in found if len(t) == most]), most)
    return out


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_keep_first_keeps_one_row_of_each_text(spark, docs, support):
    """Winners and losers that share an id or have none, and rows that are wholly equal."""
    more = [(70, "p q r"), (70, "pqr"), (71, "pq r"), (None, "v w"), (None, "vw"), (None, " v w "), (72, "vw"), (73, "y"), (73, "y "), (73, "y ")] + [(80, "five equal rows")] * 5
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = rows_of(exact_dedup.keep_first(df, support=support))
    assert Counter(got) <= Counter(rows_of(df))
    assert sorted((re.sub(r"[\x20\x09-\x0D]", "", t or ""), str((i, len(t or "")))) for i, t in got) == sorted((k, str(v)) for k, v in winners(rows_of(df)).items())
    kept = exact_dedup.keep_first(docs, support=support)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) <= Counter(map(tuple, docs.collect()))


def brute_links(rows, k, percent):
    """The set of each row, and a row's component as the rows' places in it."""
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    of = defaultdict(list)
    for i in range(len(rows)):
        of[root(i)].append(i)
    return sets, {i: of[root(i)] for i in range(len(rows))}


def smallest(rows, places):
    return min((rows[i][0] for i in places if rows[i][0] is not None), default=None)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_near_dedup(docs, k, percent):
    rows = rows_of(docs)
    sets, parts = brute_links(rows, k, percent)
    want = [(i, len(s), c := smallest(rows, parts[at]), i == c) for at, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]
    got = near_dedup.link(docs, k, percent).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:4]) for r in got)
    assert sum(r.first for r in got) == len({min(p) for p in parts.values()})


def test_near_keep_first_decides_by_row(spark, docs):
    """Ids that repeat with other texts: no text goes without a kept copy."""
    base = words(random.Random(3), 60)
    a, b = base, words(random.Random(4), 60)
    rows = [(5, a), (5, b), (8, b + " more"), (3, a), (None, a + " x"), (None, words(random.Random(5), 40))]
    df = spark.createDataFrame([(*r, 7, None) for r in rows], "doc_id long, text string, _row int, extra string")
    kept = near_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(rows_of(kept), key=str) == sorted([(3, a), (5, b), rows[5]], key=str)
    kept = near_dedup.keep_first(docs)
    _, parts = brute_links(rows_of(docs), 5, 80)
    assert kept.columns == docs.columns and kept.count() == len({min(p) for p in parts.values()})


def chain(rng, n, words, at=0):
    """Near copies, each with one word changed in the one before: the ends are not similar."""
    text, rows = [f"w{rng.randint(0, 9999)}" for _ in range(words)], []
    for i in range(n):
        text = text[:]
        text[rng.randint(0, words - 1)] = f"v{at + i}"
        rows.append((at + i, " ".join(text)))
    return rows


def test_near_dedup_of_large_groups(spark, monkeypatch):
    """Buckets and families far beyond a chunk: chains of near copies, whose ends are not similar, and apart ones among them."""
    rng = random.Random(5)
    rows = chain(rng, 60, 60) + [(100 + i, " ".join(f"z{rng.randint(0, 99999)}" for _ in range(30))) for i in range(20)]
    base = [f"q{rng.randint(0, 99999)}" for _ in range(60)]
    for i in range(60):  # copies of one text, near and less near to it
        some = base[:]
        for at in rng.sample(range(60), i % 6):
            some[at] = f"u{i}x{at}"
        rows.append((200 + i, " ".join(some)))
    _, parts = brute_links(rows, 3, 85)
    want = {i: smallest(rows, parts[at]) for at, (i, _) in enumerate(rows)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for small, chunk, size in ((3, 8, 1 << 20), (16, 256, 2000)):
        for name, value in (("SMALL", small), ("CHUNK", chunk), ("SET_BYTES", size)):
            monkeypatch.setattr(near_dedup, name, value)
        assert {r.doc_id: r.component_id for r in near_dedup.link(df, 3, 85).collect()} == want


def test_near_dedup_of_a_family_of_20000(spark, monkeypatch):
    """Every member is moved a bounded number of times."""
    rng = random.Random(9)
    base = [f"q{rng.randint(0, 99999)}" for _ in range(50)]
    rows = [(i, " ".join([*base[:-1], f"u{i}"])) for i in range(20_000)]
    moved = []
    whole = near_dedup._solved
    monkeypatch.setattr(near_dedup, "_solved", lambda rows, *how: moved.append(rows.agg({"id": "count"}).first()[0]) or whole(rows, *how))
    got = near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85)
    assert got.where("component_id <> 0").isEmpty() and got.count() == 20_000
    families = moved[-1]
    assert families < 1.1 * 20_000


def test_shingles_do_not_depend_on_company():
    texts = [b"a b c d", b"", None, b"A  b\tC d", b"x", b"a b c d e"]
    sets = list(shingle_sets(texts, 3))
    assert [len(s) for s in sets] == [2, 0, 0, 2, 1, 3]
    assert sets[0].tolist() == sets[3].tolist() == next(shingle_sets([b"a b c d"], 3)).tolist()


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(5, 5)]
    up = {}

    def root(i):
        up.setdefault(i, i)
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}


def test_empty(empty_docs):
    assert exact_dedup.decide(empty_docs).count() == 0
    assert near_dedup.link(empty_docs).count() == 0
    assert shard.shard(empty_docs).count() == 0
    assert mixing.mix(empty_docs, max_repeat=2).count() == 0


@pytest.mark.parametrize("k", [1, 3, 8, 60])
def test_shard(docs, k):
    groups, rows = defaultdict(list), rows_of(docs)
    for i, t in rows:
        groups[t or ""].append((i, len((t or "").encode()) + 1))
    order = sorted(groups, key=lambda t: ((f := least([i for i, _ in groups[t]])) is not None, f or 0, hashlib.sha256(t.encode()).hexdigest()))
    sizes = [sum(n for _, n in groups[t]) for t in order]

    def used(c):
        shards, room = 1, c
        for n in sizes:
            if n > room:
                shards, room = shards + 1, c
            room -= n
        return shards

    best = max(sizes)
    while used(best) > k:
        best += 1
    got = shard.shard(docs, k).collect()
    assert len(got) == len(rows)
    load, slots, of = Counter(), defaultdict(list), {}
    text = defaultdict(set)
    for i, t in rows:
        text[i].add(t or "")
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert any(zlib.crc32(t.encode()) == r.text_crc32 and len(t.encode()) + 1 == r.size for t in text[r.doc_id])
        assert of.setdefault(r.text_crc32, r.shard) == r.shard
    assert max(load.values()) == best and set(load) <= set(range(k))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_capacity_search(spark):
    rng = random.Random(4)
    for n, most, slices in ((5, 10, 4096), (400, 5000, 600), (300, 3, 4096)):
        sizes = [rng.randint(1, most) for _ in range(n)]
        ends, at = [], 0
        for s in sizes:
            at += s
            ends.append((at,))
        shard.SLICES, before = slices, shard.SLICES
        got, walk = shard.smallest_capacity(spark.createDataFrame(ends, "end long"), 4, at, max(sizes))
        shard.SLICES = before

        def shards(c, sizes=sizes):
            k, room = 1, c
            for s in sizes:
                if s > room:
                    k, room = k + 1, c
                room -= s
            return k

        best = max(sizes)
        while shards(best) > 4:
            best += 1
        assert got == best and walk[-1] == at


def test_mixing_budgets(docs):
    rows = mixing.mix(docs, max_repeat=1.5, block_tokens=200).collect()
    cost, n = {}, Counter()
    for r in docs.collect():
        cost[(r.doc_id, r.source)] = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) + 1
        n[r.source] += cost[(r.doc_id, r.source)]
    placed, blocks, whole = Counter(), defaultdict(Counter), defaultdict(int)
    for r in rows:
        placed[r.source] += r.tokens
        blocks[(r.source, r.block)][r["pass"]] += r.tokens
    top, least_n = max(n.values()), min(n.values())
    a = next(k / 1024 for k in range(1025) if (top / least_n) ** (1 - k / 1024) <= 1.5)
    for source in n:
        repeat = (top / n[source]) ** (1 - a)
        assert n[source] <= placed[source] <= n[source] * repeat + 1e-6
    for (source, _), passes in blocks.items():
        assert sum(passes.values()) <= passes[0] * (top / n[source]) ** (1 - a) + 1e-6
    assert Counter((r.doc_id, r.source) for r in rows if r["pass"] == 0) == Counter((r.doc_id, r.source) for r in docs.select("doc_id", "source").collect())


def test_mixing_entropy_and_budget(docs, spark):
    totals = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "source string, n long")
    import math

    def entropy(a):
        w = [x**a for x in (900, 90, 10)]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    for target in (0.5, 0.9, 1.05):
        a = mixing.bisect_exponent(totals, target_entropy=target)
        assert entropy(a) >= target > entropy(a + 1 / 1024)
    some = mixing.mix(docs, max_repeat=1.0, budget_tokens=3000, block_tokens=10**9).agg({"tokens": "sum"}).first()[0]
    assert some <= 3000
    with pytest.raises(ValueError, match="target"):
        mixing.bisect_exponent(totals)


def test_repeat_rows_places_each_row(docs):
    """As often as mix() does, row by row; columns whose names clash with those of the operator stay."""
    df = docs.where("doc_id is not null").withColumnsRenamed({"n": "_of", "block": "times", "start": "_row"})
    out = mixing.repeat_rows(df, max_repeat=2.0)
    assert out.columns == df.columns
    have, want = Counter(map(tuple, out.collect())), Counter(map(tuple, df.collect()))
    assert set(have) == set(want) and all(have[r] >= n for r, n in want.items())
    placed = Counter((r.doc_id, r.source) for r in mixing.mix(df, max_repeat=2.0).collect())
    by = Counter()
    for r, n in have.items():
        by[r[0], r[3]] += n
    assert by == placed
    few = mixing.repeat_rows(df, max_repeat=1.0, budget_tokens=3000, block_tokens=10**9)
    assert 0 < few.count() < df.count() and Counter(map(tuple, few.collect())) <= want


def test_entropy_out_of_reach(spark):
    totals = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "source string, n long")
    assert mixing.bisect_exponent(totals, target_entropy=0.01) == 1.0
    assert mixing.bisect_exponent(totals, target_entropy=5.0) == 0.0
