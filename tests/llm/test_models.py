"""Top-k against brute force; language and quality on held-out rows; the pipeline's stages."""

import random
import zlib

import numpy as np
import pytest

from radspan.llm import language_id, quality, topk


def brute_topk(rows, k, is_query):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, []).append([int(x) for x in np.floor(np.array(v, np.float64) * 1024)])
    out = []
    for q, vs in whole.items():
        if is_query(q):
            for v in vs[:1]:
                found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, ws in whole.items() if j != q for w in ws if len(w) == len(v))
                out += [(q, r, j, -s) for r, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_topk(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "SLICE", 16)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.2).astype(float).tolist()) for i in range(300)]
    rows = [(i, (np.array(v) * np.exp(rng.normal() * spread)).tolist()) for i, v in rows]
    rows += [(300 + i, rows[0][1]) for i in range(30)]
    rows += [(400, None), (405, []), (410, [1.0, None] + [0.0] * 6), (415, [float("nan")] * 8), (420, [float("inf")] * 8), (425, [0.0] * 8), (430, [-1.0] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, id string, norm double").repartition(4)
    got = topk.search(df, df.where("vec_id % 5 = 0"), 10, bucket=50)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10, lambda i: i % 5 == 0)


def test_topk_few_and_large(spark):
    rows = [(0, [3e14, 1.0]), (1, [2e11, -1.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.search(df, df, 10).collect()}
    assert len(got) == 6 and got[(0, 1)] == (1 << 63) - 1 and got[(2, 1)] == 1024 * 1024 * 200000000000 - 1024 * 1024
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def _languages():
    rng, rows = random.Random(1), []
    pools = {"aa": ["tion", "the", "ing", "and"], "bb": ["eau", "oui", "le", "ç"], "cc": ["ung", "sch", "ß", "der"]}
    for i in range(240):
        lang = list(pools)[i % 3]
        text = " ".join("".join(rng.choice(pools[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 30)))
        rows.append((i, text, lang))
    return rows


def test_language_id(spark):
    rows = _languages()
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !!", None), (1003, "THE AND ING", None), (1004, "x" * 100_000, None), (None, "le eau", None)]
    df = spark.createDataFrame([(*r, "z", 1.0) for r in rows], "doc_id long, text string, lang string, id string, score double")
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    truth = {i: lang for i, _, lang in rows if lang and i < 1000}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(got[i].held_out == (i in held) for i in truth)
    assert all(got[i].lang_pred == truth[i] for i in held)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]


def test_language_id_without_languages(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id.identify(df).collect()} == {"und"}
    assert language_id.identify(df.limit(0)).count() == 0
    one = spark.createDataFrame([(i, "abc", "en") for i in range(1, 9)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id.identify(one).collect()} == {"en"}


def test_codewords_differ():
    for n in (2, 3, 4, 8, 9, 40):
        code = language_id.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        if n >= 3:
            distances = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
            assert min(distances) >= (2 ** (n - 2) if n <= 8 else 3)


def test_quality(spark):
    rng, rows, labels = random.Random(2), [], []
    for i in range(300):
        good = i % 5 > 0
        w = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 80))]
        rows.append((i, (" ".join(w) if good else " ".join(x.upper() + "!!" for x in w)), None))
        labels.append((i, int(good)))
    rows += [(900, None, None), (901, "", None), (None, "some words", None)]
    labels += [(901, None), (None, 1), (5, 1), (5, 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, label int, x int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.scored(df, lab).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == (i % 5 > 0) for i in held) >= 0.95 * len(held)
    kept = quality.keep_good(df, lab)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


def test_quality_without_labels(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scored(df, lab).collect()} == {0.5}
    assert quality.scored(df.limit(0), lab).count() == 0


def test_ngrams_do_not_depend_on_portions():
    text = "Ein schönes  Haus, 12 Bäume ÉTÉ日本 " * 50
    whole = sorted(np.concatenate(list(language_id.ngrams(text, 1 << 30))).tolist())
    for at_once in (1, 3, 64, 1000):
        assert sorted(np.concatenate(list(language_id.ngrams(text, at_once))).tolist()) == whole
    raw = b" ein sch\xc3\xb6nes haus b\xc3\xa4ume \xc3\xa9t\xc3\xa9\xe6\x97\xa5\xe6\x9c\xac "
    assert len(list(language_id.ngrams("Ein schönes  Haus, 12 Bäume ÉTÉ日本"))[0]) == sum(len(raw) - n + 1 for n in language_id.SIZES)


def test_language_decoder_against_plain_python():
    """Loss-weighted decoding, bit by bit."""
    model = language_id.Model({x: sum((np.bincount(p, minlength=language_id.FEATURES) for _, t, lang in _languages() if lang == x for p in language_id.ngrams(t)), np.zeros(language_id.FEATURES, np.int64)) for x in ("aa", "bb", "cc")})
    for text in ("the and ing", "le eau oui ç", "der ung", "la", "x" * 200):
        places = [p for run in language_id.ngrams(text) for p in run]
        losses = []
        for word in model.code:
            loss = 0.0
            for b, bit in enumerate(word):
                odds = sum(float(model.weights[p, b]) for p in places) * min(len(places), language_id.EVIDENCE) / len(places)
                loss += model.trust[b] * np.log1p(np.exp(-odds if bit else odds))
            losses.append(loss)
        lang, score, unsure = model.predict(text)
        assert lang == model.languages[int(np.argmin(losses))]
        share = np.exp(-4 * (np.array(losses) - min(losses)))
        assert score == pytest.approx(share.max() / share.sum(), abs=1e-6)
        assert unsure == (sorted(losses)[1] - min(losses) < language_id.AMBIGUOUS)


def test_quality_fit_is_the_minimum():
    """The weights are where the mean logistic loss over all feature differences of the pairs, with the ridge, is smallest."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5))
    good = x[:, 0] + 0.5 * rng.normal(size=60) > -0.4
    monkey = quality.features
    quality.features = lambda text: np.zeros(5)
    try:
        model = quality.Model(x, good)
    finally:
        quality.features = monkey
    z = (x - x.mean(0)) / x.std(0)
    high, low = np.flatnonzero(good), np.flatnonzero(~good)
    pick = np.random.default_rng(1).integers(0, len(high), (len(low), quality.PARTNERS))

    def loss(w):
        total = 0.0
        for k, j in enumerate(low):
            for i in high[pick[k]]:
                total += np.log1p(np.exp(-float((z[i] - z[j]) @ w)))
        return total / pick.size + quality.RIDGE / 2 * float(w @ w)

    best = loss(model.weights)
    for step in np.vstack([np.eye(5), -np.eye(5)]) * 0.01:
        assert loss(model.weights + step) > best
    assert np.quantile(z @ model.weights, len(low) / 60) == pytest.approx(model.cut)


def test_quality_with_several_texts_of_an_id(spark):
    rows = [(i, f"good words number {i} here") for i in range(40)] + [(i, "BAD!! BAD!!") for i in range(40)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    models = [quality.train(spark.createDataFrame(part, "doc_id long, text string").repartition(n), lab) for part, n in ((rows, 1), (rows[::-1], 5))]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].cut == models[1].cut


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 64 * 10)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(100)]
    got = topk.search(df := spark.createDataFrame(rows, "vec_id long, embedding array<double>"), df.where("vec_id % 5 = 0"), 10)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10, lambda i: i % 5 == 0)
