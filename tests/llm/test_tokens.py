"""Packing, token files and token counts: exact against the libraries on odd texts, round trips, bounds."""

import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from radspan.llm import packing, token_counts, token_files, tokens
from radspan.llm.tokens import IdEncoder, LengthCounter, portions

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
TEXTS = st.text(st.sampled_from("ab .,'\n\t é́Σ1日!sİ　\x1c \u2581"), max_size=30)
ODD = ["", " ", "a ", " a", "a  b", "\n", "a \n b", "a\n  b", "it's we'LL", "<|endoftext|>x", "<|STARTOFTEXT|> Word", "Word, word. WORD!", "x" * 5000, "a\r\ncd", "<s> </s>", "ÉTÉ été, Été.", "▁  a", "a▁ ▁b▁"]


@pytest.fixture(scope="module")
def encoders():
    from tokenizers import Tokenizer

    return [(IdEncoder(p, cap=50), Tokenizer.from_file(p)) for p in (BYTE, WORD)]


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(encoders, texts):
    for ours, library in encoders:
        assert ours.encode(texts) == [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]


def test_ids_in_small_portions(encoders, monkeypatch):
    """Texts longer than a portion are cut between words; special strings go to the library."""
    monkeypatch.setattr(tokens, "PORTION", 40)
    texts = [*ODD, "some words and, more! " * 9, "b\n\nc  d <|endoftext|> e f " * 4]
    for ours, library in encoders:
        assert ours.encode(texts) == [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]


def test_ids_of_odd_texts(encoders):
    for ours, library in encoders:
        assert ours.cut != "none"
        assert ours.encode(ODD) == [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in ODD]


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=150, deadline=None)
def test_counts_are_those_of_the_library(texts):
    counter = test_counts_are_those_of_the_library.__dict__.setdefault("c", LengthCounter(PIECE, {"a": 1, "ab": len(LengthCounter(PIECE).lengths(["ab"]))}))
    assert not counter.whole
    assert counter.count(texts) == counter.lengths(texts)


def test_portions_hold_every_text():
    texts = [None, "a" * 10, "b" * 30, "", "c"]
    assert [(s, list(t)) for s, t in portions(texts, 20)] == [(0, ["", "a" * 10]), (2, ["b" * 30]), (3, ["", "c"])]


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=60, deadline=None)
def test_sum_of_squares_packs_without_gaps(lengths):
    lengths = sorted(lengths, reverse=True)
    sequence, offset = packing.sum_of_squares(lengths, 64)
    filled = defaultdict(int)
    for n, s, o in zip(lengths, sequence, offset, strict=True):
        assert o == filled[s]
        filled[s] += n
    assert all(v <= 64 for v in filled.values())
    # never two sequences half empty, so at most twice the least number
    assert sum(v <= 32 for v in filled.values()) <= 1


def test_sum_of_squares_picks_the_smallest_sum():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 20, 120).tolist()
    sequence, _ = packing.sum_of_squares(lengths, 20)
    gaps = {}
    for n, s in zip(lengths, sequence, strict=True):
        counts = np.bincount(list(gaps.values()), minlength=21)
        cost = {}
        for g in {g for g in gaps.values() if g >= n}:
            c = counts.copy()
            c[g] -= 1
            c[g - n] += 1
            cost[g] = int((c[1:] ** 2).sum())
        if cost:
            assert s in gaps and cost[gaps[s]] == min(cost.values())
        gaps[s] = gaps.get(s, 20) - n


def _library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _pieces(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def test_packing_of_odd_rows(docs):
    from tokenizers import Tokenizer

    library, want = Tokenizer.from_file(BYTE), []
    for i, t in _pieces(docs):
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        a, b, p = 0, (len(ids) - 1) % 128 + 1, 0
        while a < len(ids):
            want.append((i, p, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())))
            a, b, p = b, b + 128, p + 1
    got = packing.pack(docs, BYTE, capacity=128).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for rows in by.values():
        at = 0
        for o, n in sorted(rows):
            assert o == at
            at += n
        assert at <= 128
    assert len(by) <= 1.05 * -(-sum(r.length for r in got) // 128) + 1


def test_sequences_hold_their_pieces(docs, spark):
    """Rows that repeat an id, or a whole row, or have no id, have pieces of their own."""
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(3, "b c " * 400)] * 2 + [(None, "x"), (None, "y y")], "doc_id long, text string"))
    want = [array("I", e).tobytes() for e in ([*x.ids, 0] for x in _library(BYTE).encode_batch([t for _, t in _pieces(rows)], add_special_tokens=False))]
    got = packing.sequences(rows, BYTE, 256).collect()
    assert sum(len(s.ids) for s in got) == sum(map(len, want))
    parts = Counter()
    for s in got:
        assert len(s.ids) == 4 * sum(p.length for p in s.pieces) <= 1024
        for p in s.pieces:
            parts[p.doc_id, p.start, bytes(s.ids[4 * p.offset : 4 * (p.offset + p.length)])] += 1
    expected = Counter()
    for (i, _), ids in zip(_pieces(rows), want, strict=True):
        n = len(ids) // 4
        cuts = [0, *range((n - 1) % 256 + 1, n + 1, 256)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            expected[i, a, ids[4 * a : 4 * b]] += 1
    assert parts == expected


def test_empty_tables(spark, empty_docs, tmp_path):
    assert packing.pack(empty_docs, BYTE).count() == 0
    token_files.write(empty_docs, WORD, f"file://{tmp_path}/t")
    assert token_files.read(spark, f"file://{tmp_path}/t").count() == 0
    assert token_counts.count_tokens(empty_docs, PIECE).count() == 0


def test_token_files_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    token_files.write(docs, WORD, f"file://{tmp_path}/t")
    got = token_files.read(spark, f"file://{tmp_path}/t").collect()
    want = sorted(str((i, array("I", [*library.encode(t, add_special_tokens=False).ids, 1]).tobytes())) for i, t in _pieces(docs))
    assert sorted(str((r.doc_id, bytes(r.ids))) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


@given(st.lists(st.integers(0, 300), max_size=2000), st.sampled_from([1, 7, 512]), st.sampled_from([64, 1 << 19]))
@settings(max_examples=60, deadline=None)
def test_huffman_round_trip(ids, block, at_once):
    ids = np.array(ids, np.int64)
    lengths = token_files.code_lengths(np.bincount(ids, minlength=301) if len(ids) else np.zeros(301, np.int64))
    payload, checkpoints = token_files.encode(ids, lengths, token_files.canonical_codes(lengths), block, at_once)
    assert token_files.Decoder(lengths, block).decode(payload, checkpoints, len(ids)).tolist() == ids.tolist()


def test_code_lengths_are_limited_and_optimal():
    counts = np.array([1 << i for i in range(30)])
    for longest in (5, 8, 20):
        n = token_files.code_lengths(counts, longest).astype(float)
        assert n.max() <= longest and (2.0**-n).sum() <= 1
    small = np.array([45, 13, 12, 16, 9, 5])
    assert (token_files.code_lengths(small) * small).sum() == 224  # a textbook Huffman cost


def test_token_counts_of_odd_rows(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = sorted(str((i, len(t.encode()), n := len(library.encode(t)), n > 100)) for i, t in _pieces(docs))
    assert sorted(str(tuple(r)) for r in token_counts.count_tokens(docs, PIECE, limit=100).collect()) == want


def test_token_counts_where_tasks_have_no_unit(spark):
    schema = "doc_id long, text string"
    few = spark.createDataFrame([(1, "a b"), (2, "▁  c")], schema).repartition(8, "doc_id")
    assert sorted(tuple(r)[:3] for r in token_counts.count_tokens(few, PIECE).collect()) == [(1, 3, 2), (2, 6, len(LengthCounter(PIECE).model.encode("▁  c")))]
    blank = spark.createDataFrame([(i, ("", None)[i % 2]) for i in range(5)], schema).repartition(3)
    assert sorted(tuple(r) for r in token_counts.count_tokens(blank, PIECE).collect()) == [(i, 0, 0, False) for i in range(5)]


def test_equal_rows_without_id_are_spread_over_groups(spark):
    """Rows that agree in everything but their number."""
    rows = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "id as row", "0 as piece", "0L as start", "700L as length")
    placed = packing.place(rows, 4).collect()
    sizes = Counter(r.sequence_id >> 40 for r in placed)
    assert len(sizes) == 4 and max(sizes.values()) < 6_000
    assert len({(r.sequence_id, r.offset) for r in placed}) == 20_000


def test_number_of_groups_is_bounded():
    assert [packing.n_groups(n) for n in (0, 1, 65_537, 1 << 30, 10**10)] == [1, 1, 2, 4096, 9537]


def test_models_with_dropout_are_never_cut():
    from radspan.llm.tokens import IdEncoder

    made = {"model": {"type": "BPE", "dropout": 0.1}, "post_processor": {"type": "ByteLevel"}, "pre_tokenizer": {"type": "ByteLevel"}}
    assert IdEncoder._cut_of(made) not in ("space", "word")
    assert IdEncoder._cut_of(made | {"model": {"type": "BPE"}}) == "space"
