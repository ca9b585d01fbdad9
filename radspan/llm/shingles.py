"""Word shingles of whole texts as sets of 64-bit numbers, and their MinHash marks; numpy inside tasks.

Words are runs of bytes outside [\\x20\\x09-\\x0D] after lower-casing A-Z. A word's number is a polynomial hash of its
bytes (computed for all words of a portion from one running sum), a shingle's number mixes those of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_MASK = (1 << 64) - 1
PORTION = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64 bits (two multiply and xor-shift rounds)."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_BYTES = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, b, U)]), dtype=U)
    return _powers


def word_numbers(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of a blob and the places where they start."""
    raw = np.frombuffer(blob.lower(), np.uint8)  # of bytes, lower() touches A-Z only
    if not len(raw):
        return np.zeros(0, U), np.zeros(0, np.int64)
    edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(max(len(raw) + 1, PORTION + 1))
    run = np.concatenate([np.zeros(1, U), np.cumsum(_BYTES[raw] * up[: len(raw)], dtype=U)])
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(U)), start


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about PORTION bytes, cut at white space."""
    a = 0
    while len(text) - a > PORTION:
        b = a + PORTION
        while b < len(text) and not _SPACE[text[b]]:
            b += 1
        yield text[a:b]
        a = b
    yield text[a:]


def _combined(words: np.ndarray, k: int) -> np.ndarray:
    """The numbers of all runs of k words."""
    out = np.full(len(words) - k + 1, k, U)
    for j in range(k):
        out = mix(out * U(0xD6E8FEB86659FD93) + words[j : len(words) - k + 1 + j])
    return out


def shingle_sets(texts: list[bytes | None], k: int) -> Iterator[np.ndarray]:
    """For each text its sorted set of k-word shingles; of fewer words, the whole sequence as one; of none, empty."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or b"") < PORTION):
            size += len(texts[j] or b"") + 1
            j += 1
        part = [t or b"" for t in texts[i:j]]
        if len(part) == 1:
            words = np.concatenate([word_numbers(p)[0] for p in _pieces(part[0])])
            bounds = [0, len(words)]
        else:
            words, start = word_numbers(b" ".join(part))
            bounds = [0, *np.searchsorted(start, np.cumsum([len(p) + 1 for p in part])).tolist()]
        every = _combined(words, k) if len(words) >= k else np.zeros(0, U)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(every[a : b - k + 1]) if b - a >= k else _combined(words[a:b], b - a) if b > a else np.zeros(0, U)
        i = j


class MinHash:
    """Minima of universal hash functions a * x + b modulo 2 ** 64, banded."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        n = bands * rows
        self.a = mix(np.arange(1, n + 1, dtype=U) * U(0xA24BAED4963EE407)) | U(1)
        self.b = mix(np.arange(1, n + 1, dtype=U) * U(0x9FB21C651E98DF25))

    def marks(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each non-empty set a byte of each minimum, and a number for each band."""
        x, starts = np.concatenate(sets), np.cumsum([0, *[len(s) for s in sets[:-1]]])
        low = np.empty((len(self.a), len(sets)), U)
        for i, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
            np.minimum.reduceat(x * a + b, starts, out=low[i])
        signature = (mix(low) >> U(56)).astype(np.uint8).T
        number = np.repeat(np.arange(self.bands, dtype=U)[:, None], len(sets), 1)
        for j in range(self.rows):
            number = mix(number * U(0xD6E8FEB86659FD93) + low[j :: self.rows])
        return np.ascontiguousarray(signature), number.T.astype(np.int64)
