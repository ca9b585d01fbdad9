"""The pipeline against plain Python: every stage after the classifier, and how often each document is placed."""

import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from radspan.llm import quality

SPACE = r"[\x20\x09-\x0D]"


def good_rows(spark, rows, labels):
    """The classifier is fitted by the library; its features and its threshold are applied here row by row."""
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    return [r for r in rows if model.score(r[1] or "") >= 0.3]


def exact_rows(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(SPACE, "", r[1] or "")].append(r)
    out = []
    for found in groups.values():
        most = max(len(t or "") for _, t, _ in found)
        out.append(min((r for r in found if len(r[1] or "") == most), key=lambda r: (r[0] is not None, r[0] or 0)))
    return out


def near_rows(rows, k=5, percent=80):
    sets = []
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    first = {}
    for i, (d, *_) in enumerate(rows):
        first[root(i)] = min(first.get(root(i), (2, 0, 0)), (d is None, d or 0, i))
    return [rows[i] for _, _, i in sorted(first.values())]


def hashed(*parts):
    return int(hashlib.md5(":".join(p for p in parts if p is not None).encode()).hexdigest()[:15], 16)


def placements(rows, max_repeat=2.0, seed="mix-1", block_tokens=1 << 16):
    """How often each row is placed."""
    cost = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for _, t, _ in rows]
    total = Counter()
    for (_, _, s), c in zip(rows, cost, strict=True):
        total[s] += c
    top, low = max(total.values()), min(total.values())
    a = next(k / 1024 for k in range(1025) if (top / low) ** (1 - k / 1024) <= max_repeat)
    blocks = defaultdict(list)
    for at, (i, _, s) in enumerate(rows):
        blocks[s, hashed(seed, "block", None if i is None else str(i)) % math.ceil(total[s] / block_tokens)].append(at)
    times = Counter()
    for (s, _), found in blocks.items():
        repeat, whole = (top / total[s]) ** (1 - a), sum(cost[x] for x in found)
        for p in range(math.ceil(repeat)):
            end = p * whole
            for at in sorted(found, key=lambda x: (hashed(seed, str(p), None if rows[x][0] is None else str(rows[x][0])), rows[x][0] is not None, rows[x][0] or 0, cost[x])):
                end += cost[at]
                times[at] += end <= math.floor(whole * repeat)
    return [times[at] for at in range(len(rows))]


def test_whole_pipeline(spark, tmp_path):
    rng, rows, labels = random.Random(11), [], []
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi") for b in ("na", "ru", "so", "ti", "ve")]
    for i in range(150):
        w = [rng.choice(words) for _ in range(rng.randint(8, 120))]
        rows.append((i, " ".join(w) if i % 6 else " ".join(x.upper() + "!!" for x in w), ("web", "web", "web", "web", "code", "book", None)[i % 7]))
        labels.append((i, int(i % 6 > 0)))
    long = " ".join(rng.choice(words) for _ in range(3000))
    base = rows[1][1]
    rows += [(200, long, "book"), (201, long + " more", "web"), (202, base.replace(" ", "\n", 2), "web"), (203, base.replace(" ", "  ", 3), "code"), (204, base + " tail", "web")]
    rows += [(210, rows[2][1] + " ", "code"), (210, rows[2][1], "code"), (2, rows[2][1].replace(" ", ""), "web")]
    rows += [(None, rows[3][1] + " tail", None), (5, rows[3][1] + " tail", None), (None, "", "web"), (0, None, "code")]  # copies without an id
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    left = near_rows(exact_rows(good_rows(spark, rows, labels)))
    assert len(left) < len(rows) - 20
    times = placements(left)
    assert set(times) == {1, 2}
    library, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for (i, t, _), n in zip(left, times, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        a, b, p = 0, (len(ids) - 1) % 2048 + 1, 0
        while a < len(ids):
            want[i, p, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())] += n
            a, b, p = b, b + 2048, p + 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for found in by.values():
        at = 0
        for o, n in sorted(found):
            assert o == at
            at += n
        assert at <= 2048
