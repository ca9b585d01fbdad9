"""Exact token ids and counts of whole texts, through a cache of the units that a tokenizer never joins.

A unit is a stretch of text whose tokens do not depend on its neighbours: for the byte-level and the lower-casing
vocabulary a run of letters, digits or marks with the space before it, for the sentencepiece one a run of spaces with
the word after it. encode(text) is then the concatenation of the units' ids. A tokenizer of any other make is applied
to the whole text.

Caches hold at most a given number of units, about; long units are not kept.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEEP_LENGTH = 48
#: Bytes of text that are cut into units together.
PORTION = 1 << 20


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TwoGenerations:
    """Values by unit, of about two times `cap` units at most: when `now` is full, it becomes `old`, and that is forgotten."""

    def __init__(self, cap: int):
        self.cap, self.now, self.old = cap, {}, {}

    def missing(self, keys: set) -> set:
        """The keys that must be computed; those of the older generation move to the younger one."""
        out = keys.difference(self.now)
        if self.old and (back := self.old.keys() & out):
            self.now.update(zip(back, map(self.old.__getitem__, back), strict=True))
            out -= back
        return out

    def get(self, key):
        return self.now.get(key) or self.old.get(key)

    def tidy(self, long_keys: list) -> None:
        for k in long_keys:
            self.now.pop(k, None)
        if len(self.now) > self.cap:
            self.old, self.now = self.now, {}


#: Classes of bytes: what a unit may be made of and where it may be cut. Other bytes (0) are never cut from their neighbours.
_LETTER, _DIGIT, _PUNCT, _APOSTROPHE, _SPACE, _BREAK, _HIGH = range(1, 8)


def _byte_classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for kind, members in (
        (_LETTER, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (_DIGIT, b"0123456789"),
        (_PUNCT, b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"),
        (_APOSTROPHE, b"'"),
        (_SPACE, b" "),
        (_BREAK, b"\t\n\r\x0b\x0c"),
        (_HIGH, bytes(range(0xC3, 0xE0))),  # first bytes of characters that are never white space
    ):
        out[list(members)] = kind
    return out


_CLASSES = _byte_classes()
_SURE = np.isin(np.arange(8), (_LETTER, _DIGIT, _PUNCT, _APOSTROPHE, _HIGH))  # surely not white space


def _cut_between() -> np.ndarray:
    """[a, b]: a token always ends between a byte of class a and one of class b."""
    out = np.zeros((8, 8), bool)
    plain = (_LETTER, _DIGIT, _PUNCT)
    for a in (*plain, _APOSTROPHE):
        out[a, [_SPACE, _BREAK]] = out[_BREAK, a] = True
    out[_BREAK, _HIGH] = out[_LETTER, _APOSTROPHE] = out[_DIGIT, _APOSTROPHE] = True
    for a in plain:
        for b in plain:
            out[a, b] = a != b
    return out.reshape(-1)


_BETWEEN = _cut_between()


def unit_starts(raw: np.ndarray, bounds: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts that lie one after another (bounds: their starts and the end) cut into units: the bytes, with
    letters up to U+00FF in lower case if `fold`, the units' starts, and the classes of the bytes.

    A space goes with the word after it. Of a run of white space the last one is cut off if a word follows, since the
    tokenizers take it apart from the others.
    """
    kind = _CLASSES[raw]
    if raw.max(initial=0) >= 0x80:
        lead = np.flatnonzero(raw == 0xC3)  # U+00C0 to U+00FF are letters but for the signs of multiplication and division
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        if fold:
            raw = raw.copy()
            raw[lead[raw[lead + 1] < 0x9F] + 1] += 0x20
    if fold:
        raw = np.where((raw >= 0x41) & (raw <= 0x5A), raw | 0x20, raw).astype(np.uint8)
    cut = np.zeros(len(raw), bool)
    cut[1:] = ((kind[:-1] == _SPACE) | (kind[:-1] == _BREAK)) & _SURE[kind[1:]]
    cut[bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(raw))]] = False  # what follows is another text's
    cut[:-1] = cut[1:]
    cut[-1:] = False
    cut[1:] |= _BETWEEN[kind[:-1] * np.uint8(8) + kind[1:]]
    cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
    return raw, np.flatnonzero(cut), kind


def _binary(raw: np.ndarray, starts: np.ndarray, end: int) -> pa.Array:
    """The stretches of raw from each start to the next, without a copy."""
    offsets = np.append(starts, end).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def flattened(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of strings (null: empty), and the bounds of its rows in them."""
    column = pc.fill_null(pc.cast(column, pa.string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


class _Units:
    """Ids of known units in one array. Beyond `cap` units, those that most portions have used stay, half of cap."""

    def __init__(self, cap: int):
        self.cap = cap
        self._set(pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int32))

    def _set(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray, uses: np.ndarray) -> None:
        self.keys, self.sizes, self.ids, self.uses = keys, sizes, ids, uses
        self.starts = np.cumsum(sizes) - sizes

    def numbers(self, units: pa.Array) -> np.ndarray:
        """The place of each unit, -1 where it is not known."""
        return pc.fill_null(pc.index_in(units, value_set=self.keys), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, units: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Puts new units behind the known ones and gives their places."""
        places = np.arange(len(units)) + len(self.keys)
        self._set(pa.concat_arrays([self.keys, units]), np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids]), np.concatenate([self.uses, np.zeros(len(sizes), np.int32)]))
        return places

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units with these numbers, one after another, and how many each has."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return self.ids[at], sizes

    def tidy(self) -> None:
        """Forgets long units, and rare ones when there are too many."""
        lengths = pc.binary_length(self.keys).to_numpy(zero_copy_only=False)
        keep = lengths <= KEEP_LENGTH
        if keep.sum() > self.cap:
            order = np.argsort(np.where(keep, -self.uses, 1), kind="stable")[: self.cap // 2]
            keep = np.zeros(len(keep), bool)
            keep[order] = True
            self.uses //= 2
        if not keep.all():
            some = np.flatnonzero(keep)
            ids, sizes = self.gathered(some)
            self._set(self.keys.take(pa.array(some)), sizes, ids, self.uses[some])


class IdEncoder:
    """Ids of texts by a tokenizers file; special tokens are not added.

    A portion of texts is cut into units as bytes; each distinct unit is looked up in the cache, or encoded by the
    library, once; the ids of the texts are then gathered from the cache. Texts with the string of a special token, and
    tokenizers of any other make, go to the library as they are.
    """

    def __init__(self, path: str, cap: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.cut = self._cut_of(made)
        self.special = [t["content"].encode() for t in made.get("added_tokens") or []]
        self.units = _Units(cap)
        letters = _byte_letters()
        # the same model for words that are cut already, many in one call
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Split(letters[32], "merged_with_next") if self.cut == "space" else pre_tokenizers.CharDelimiterSplit(" ")
        self.letters = np.array([ord(letters[b]) for b in range(256)], "<u4")
        if self.cut == "word":
            self.letters[32] = 32
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.vocabulary)]
        self.edge = np.array([t.startswith(letters[32]) if self.cut == "space" else t.endswith("</w>") for t in tokens])

    @staticmethod
    def _cut_of(made: dict) -> str:
        pre, model = made.get("pre_tokenizer") or {}, made["model"]
        inert = model["type"] == "BPE" and not model.get("dropout") and (made.get("post_processor") or {}).get("type", "ByteLevel") == "ByteLevel"
        added = made.get("added_tokens") or []
        inert = inert and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] for t in added)
        if inert and made.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
            return "space"
        steps = [x["type"] for x in (made.get("normalizer") or {}).get("normalizers", [])]
        parts = pre.get("pretokenizers") or [{}]
        if inert and steps == ["NFC", "Replace", "Lowercase"] and parts[0].get("behavior") == "Removed" and parts[0].get("invert") and [p["type"] for p in parts] == ["Split", "ByteLevel"]:
            return "word"
        return "none"

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _of_words(self, raw: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of n units that are a space and one word each. Every word has one token that tells where it starts, or ends."""
        ids = np.array(self.words.encode_batch_fast([self.letters[raw].tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(self.edge[ids])
        if len(at) != n:
            raise ValueError("the tokenizer's words cannot be told apart")
        return ids, np.diff(at, append=len(ids)) if self.cut == "space" else np.diff(at, prepend=-1)

    def _learn(self, units: pa.Array) -> np.ndarray:
        """Puts the ids of new units into the cache and gives their places."""
        raw, bounds = np.frombuffer(units.buffers()[2], np.uint8), np.frombuffer(units.buffers()[1], np.int32)
        kind = unit_starts(raw, bounds, False)[2]
        odd = ~np.isin(kind, (_LETTER, _PUNCT) if self.cut == "word" else (_LETTER, _DIGIT, _PUNCT))
        first = bounds[:-1]
        odd[first[raw[first] == 32]] = False
        numbers = np.empty(len(units), np.int64)
        plain = (raw[first] == 32) & (np.diff(bounds) > 1) & ~np.logical_or.reduceat(odd, first)
        for some in np.array_split(np.flatnonzero(plain), plain.sum() // 20_000 + 1):
            if len(some):
                part = units.take(pa.array(some))
                own, sizes = self._of_words(np.frombuffer(part.buffers()[2], np.uint8), len(some))
                numbers[some] = self.units.add(part, sizes, own)
        rest = units.filter(pa.array(~plain))
        if len(rest):
            own, sizes = self._library([u.decode() for u in rest.to_pylist()])
            numbers[~plain] = self.units.add(rest, sizes, own)
        return numbers

    def _of_bytes(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that lie in raw, and how many each has."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        raw, starts, _ = unit_starts(raw, bounds, self.cut == "word")
        cut = _binary(raw, starts, len(raw)).dictionary_encode()
        numbers = self.units.numbers(cut.dictionary)
        if (new := numbers < 0).any():
            numbers[new] = self._learn(cut.dictionary.filter(pa.array(new)))
        self.units.uses[numbers] += 1
        ids, sizes = self.units.gathered(numbers[cut.indices.to_numpy()])
        self.units.tidy()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.searchsorted(starts, bounds)])

    def _of_long(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one long text, in stretches that end where a space stands between two letters."""
        a, out = 0, []
        while len(raw) - a > PORTION:
            size = PORTION
            while True:
                kind = _CLASSES[raw[a : a + size]]
                at = np.flatnonzero((kind[1:-1] == _SPACE) & (kind[:-2] == _LETTER) & (kind[2:] == _LETTER))
                if len(at) or a + size >= len(raw):
                    break
                size *= 2
            if not len(at):
                break
            b = a + int(at[-1]) + 1
            out.append(self._of_bytes(raw[a:b], np.array([0, b - a]))[0])
            a = b
        out.append(self._of_bytes(raw[a:], np.array([0, len(raw) - a]))[0])
        ids = np.concatenate(out)
        return ids, np.array([len(ids)], np.int64)

    def _has_special(self, raw: np.ndarray) -> bool:
        return any(x in raw.tobytes() for x in self.special)

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """A column of texts (null: empty) in portions: the first row, the ids of its texts one after another, how many each has."""
        raw, bounds = flattened(column)
        first = 0
        while first < len(bounds) - 1:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PORTION, side="right")) - 1)
            own, at = raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
            if self.cut == "none" or self._has_special(own):
                if last - first > 1:  # text by text
                    last, own, at = first + 1, raw[bounds[first] : bounds[first + 1]], bounds[first : first + 2] - bounds[first]
                if self.cut == "none" or self._has_special(own):
                    yield first, *self._library([own.tobytes().decode()])
                    first = last
                    continue
            yield first, *(self._of_long(own) if last - first == 1 else self._of_bytes(own, at))
            first = last

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for _, ids, sizes in self.encode_column(pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary()).cast(pa.string())):
            ends = np.cumsum(sizes)
            out += [ids[a:b].astype("<u4").tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        return out


_kept: dict[str, IdEncoder] = {}


def id_encoder(path: str) -> IdEncoder:
    """The worker's encoder for this file: later tasks of the worker find the vocabulary loaded and the cache filled."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = IdEncoder(path)
    return _kept[path]


def gathered(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until a column of strings has about PORTION bytes: distinct units are looked up once a batch."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= PORTION:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class LengthCounter:
    """Token counts of texts by a sentencepiece model: frequent units from a given table, others through the cache."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None, cap: int = 300_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cache = TwoGenerations(cap)
        self.known = frequent or {}
        self.tiers = _Tiers(self.known, self.cache)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        mark = "▁"
        joins = any(mark in p.lstrip(mark) for p in pieces)
        keeps = "".join(self.model.encode("  x y ﬁ z  ", out_type=str)) == f"{mark * 3}x{mark}y ﬁ{mark}z{mark * 2}"
        self.whole = joins or not keeps or self.model.piece_to_id(mark) == self.model.unk_id()

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    @staticmethod
    def units(text: str) -> list[str]:
        """The words between single spaces; a longer run of spaces goes, without its first, with the word after it.

        The model writes a space as U+2581, so that letter is a space to it.
        """
        units = text.replace("\u2581", " ").split(" ")
        return [u[1:] for u in re.findall(r" +[^ ]*", " " + " ".join(units))] if "" in units else units

    def count(self, texts: list[str]) -> list[int]:
        if self.whole:
            return self.lengths(texts)
        cut = [self.units(t) if t else [] for t in texts]
        tiers, now = self.tiers, self.cache.now
        need = list(self.cache.missing(set().union(*cut).difference(self.known)))
        now.update(zip(need, self.lengths(need), strict=True))
        if "" in now:
            now[""] = 1  # a space that ends the text is a token of its own
        out = [sum(map(tiers.__getitem__, u)) for u in cut]
        self.cache.tidy([k for k in need if len(k) > KEEP_LENGTH])
        return out


class _Tiers(dict):
    """The frequent table; what it lacks is looked up in the worker's cache."""

    def __init__(self, frequent: dict[str, int], cache: TwoGenerations):
        super().__init__(frequent)
        self.cache = cache

    def __missing__(self, unit):
        return self.cache.now[unit]


def portions(texts: list, most: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts (null: empty) with their first place, of about `most` characters; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > most:
            yield start, [x or "" for x in texts[start:i]]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, [x or "" for x in texts[start:]]
