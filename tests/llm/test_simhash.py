"""Fingerprints and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from radspan.llm import near_dedup, simhash


def _print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(rows, radius=3):
    """rows: (id, fingerprint); the least id that each fingerprint reaches."""
    marks = sorted({m for _, m in rows})
    up = {m: m for m in marks}

    def root(m):
        while up[m] != m:
            m = up[m]
        return m

    for i, a in enumerate(marks):
        for b in marks[:i]:
            if (a ^ b).bit_count() <= radius:
                up[root(a)] = root(b)
    least = {}
    for i, m in rows:
        if i is not None:
            least[root(m)] = min(least.get(root(m), i), i)
    return {m: least.get(root(m)) for m in marks}


def test_odd_rows(docs):
    rows = [(r.doc_id, _print(r.text)) for r in docs.collect()]
    of = _components(rows)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.link(docs).collect()), key=str)
    assert got == sorted(((i, f"{m:016x}", of[m]) for i, m in rows), key=str)


def test_fingerprints_do_not_hang_on_portions(monkeypatch):
    from radspan.llm import shingles

    rng = random.Random(3)
    texts = [" ".join(rng.choice("a B cd éf gh".split()) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 400)] + ["", " \n", "x" * 100]
    monkeypatch.setattr(shingles, "PORTION", 16)
    assert [simhash.fingerprint(t.encode()) & (1 << 64) - 1 for t in texts] == [_print(t) for t in texts]


def _cloud(rng, n, centres=4):
    """Marks around a few centres, at all distances near the radius."""
    middle = [rng.getrandbits(64) for _ in range(centres)]
    return sorted({m ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for m in (rng.choice(middle) for _ in range(n))} | {0, (1 << 64) - 1, 1 << 63})


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_near_lanes_are_the_distances(radius):
    marks = np.array(_cloud(random.Random(radius), 150), np.uint64)
    sliced, n = simhash.planes(marks), len(marks)
    for lag in (1, 2, 63, 64, 65, 100):
        wanted = np.zeros(sliced.shape[1] * 64, bool)
        wanted[: max(0, n - lag)] = True
        got = simhash.near_lanes(sliced, lag, simhash._lanes(wanted), radius)
        assert sorted(got.tolist()) == [i for i in range(n - lag) if (int(marks[i]) ^ int(marks[i + lag])).bit_count() <= radius]


def test_joined_gives_a_forest_of_each_group():
    rng = random.Random(1)
    marks = _cloud(rng, 120)
    group = np.sort(np.array([rng.randint(0, 3) for _ in marks]))
    pairs = list(simhash.joined(group, np.array(marks, np.uint64), np.arange(len(marks)), None, 3))
    for g in range(4):
        at = np.flatnonzero(group == g)
        want = _components([(int(i), marks[i]) for i in at])
        up = {int(i): int(i) for i in at}
        for i, j in pairs:
            if group[i] == g:
                a, b = i, j
                while up[a] != a:
                    a = up[a]
                while up[b] != b:
                    b = up[b]
                assert a != b and group[j] == g  # a tree
                up[max(a, b)] = min(a, b)
        for i in up:
            a = i
            while up[a] != a:
                a = up[a]
            assert a == want[marks[i]]


@pytest.mark.parametrize("chunk", [8, 1024])
def test_links_of_clouds_in_chunks(spark, monkeypatch, chunk):
    """A bucket far beyond a chunk, and one class at several distances of others."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "BATCH_ROWS", 64)
    marks = _cloud(random.Random(5), 400)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    from radspan.llm.common import work_table
    from radspan.llm.components import components

    classes = work_table(spark.createDataFrame([(m,) for m in signed], "mark long").repartition(3), "classes")
    got = {r.id: r.component for r in components(simhash.class_links(classes)).collect()}
    want = _components(list(zip(signed, marks, strict=True)))
    assert {m: got.get(s, s) for s, m in zip(signed, marks, strict=True)} == want


@pytest.mark.parametrize("classes,tables", [(0, 4), (1 << 22, 4), ((1 << 22) + 1, 10), (1 << 33, 20), (1 << 40, 35)])
def test_masks_grow_with_the_classes_and_miss_no_pair(classes, tables):
    masks = simhash.masks(classes)
    assert len(masks) == tables
    rng = random.Random(0)
    for _ in range(300):
        differ = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(m & differ == 0 for m in masks)


def test_empty_table(empty_docs):
    assert simhash.link(empty_docs).isEmpty()


def test_near_dedup_still_takes_its_own_solver(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(60)) + (f" e{i}" if i else "")) for i in range(40)]
    got = near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert got.where("component_id <> 0").isEmpty()
