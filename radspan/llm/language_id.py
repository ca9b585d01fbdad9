"""Language identification with error-correcting output codes.

Every language has a codeword of bits; a binary classifier per bit tells from hashed byte n-grams (of lower-cased
letters, other characters read as one space) whether the text's language has that bit. A classifier's weights are log
odds of smoothed n-gram counts, so training is one pass that adds up counts per language over all labelled rows of the
training fold. A text goes to the codeword with the smallest logistic loss, each bit weighted by how far its
classifier's two sides lie apart; where the second best is close, the text is flagged as ambiguous.

Defined cases: a null text, or one without a letter, is `und` with score 0; a null language teaches nothing; with no
language learned every text is `und`; with one, every text with a letter is of that one; ties go to the language that
comes first in order; rows that repeat stay; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import small_batches

FOLDS = 5
SIZES, BITS = (2, 3, 4), 15
FEATURES = len(SIZES) << BITS
SMOOTH = 0.5
#: Evidence of so many n-grams at most goes into a loss, so that long texts do not saturate it.
EVIDENCE = 60
#: A second language within so much loss makes a text ambiguous.
AMBIGUOUS = 0.25
GROUPS = 32
#: Bytes of a text whose n-grams are looked up together; the result does not depend on it.
PORTION = 1 << 15
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "utf-8")) % FOLDS == 0, F.lit(False))


def ngrams(text: str, at_once: int = PORTION) -> Iterator[np.ndarray]:
    """Places of the text's hashed n-grams, one for each occurrence, in runs of about len(SIZES) * at_once."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace").translate(_LETTERS), np.uint8)
    space = raw == 0x20
    raw = raw[~(space & np.concatenate([[False], space[:-1]]))]
    for a in range(0, len(raw), at_once):
        part, out = raw[a : a + at_once + max(SIZES) - 1].astype(np.uint32), []
        for k, n in enumerate(SIZES):
            m = min(at_once, len(part) - n + 1)  # n-grams that start in this run
            if m > 0:
                code = part[:m]
                for j in range(1, n):
                    code = code << np.uint32(8) | part[j : m + j]
                out.append(((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32) + (k << BITS))
        if out:
            yield np.concatenate(out)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = totals.setdefault(lang, np.zeros(FEATURES, np.int64))
            for places in ngrams(text):
                n += np.bincount(places, minlength=FEATURES)
    task = TaskContext.get().partitionId()
    for lang, n in totals.items():
        yield pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "lang": pa.array([lang]), "counts": pa.array([n.tobytes()], pa.binary())})


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            totals[lang] = totals.get(lang, 0) + np.frombuffer(packed, np.int64)
    for lang, n in totals.items():
        yield pa.RecordBatch.from_pydict({"task": pa.array([0], pa.int32()), "lang": pa.array([lang]), "counts": pa.array([n.tobytes()], pa.binary())})


def codewords(n: int) -> np.ndarray:
    """n codewords: all splits of up to eight languages, or pseudo-random bits with a distance that grows with n."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 8:
        return np.array([[(c >> i) & 1 for c in range(1, 1 << (n - 1))] for i in range(n)], np.int8).reshape(n, -1)
    bits = 15 + 8 * int(np.ceil(np.log2(n)))
    return np.random.default_rng(1).permuted(np.tile(np.arange(n)[:, None] % 2, (1, bits)), axis=0).astype(np.int8)


class Model:
    """Languages in order, their codewords, the classifiers' weights (n-gram by bit) and the bits' weights."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        self.code = codewords(len(self.languages))
        table = np.array([counts[x] for x in self.languages], np.float64).reshape(len(self.languages), FEATURES)
        # languages weigh alike, however many texts they have
        table = (table + SMOOTH) / (table.sum(1, keepdims=True) + SMOOTH * FEATURES)
        self.weights = np.zeros((FEATURES, self.code.shape[1]), np.float32)
        self.trust = np.zeros(self.code.shape[1])
        for b in range(self.code.shape[1]):
            one, zero = table[self.code[:, b] == 1].mean(0), table[self.code[:, b] == 0].mean(0)
            odds = np.log(one) - np.log(zero)
            self.weights[:, b], self.trust[b] = odds, ((one - zero) * odds).sum()
        self.trust /= max(self.trust.sum(), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        odds, n = np.zeros(self.weights.shape[1]), 0
        for places in ngrams(text):
            odds += self.weights.take(places, 0).sum(0, dtype=np.float64)
            n += len(places)
        odds *= min(n, EVIDENCE) / n
        losses = np.logaddexp(0, np.where(self.code == 1, -odds, odds)) @ self.trust
        first, second = np.argsort(losses, kind="stable")[:2]
        share = np.exp(-4 * (losses - losses.min()))
        return self.languages[first], float(share[first] / share.sum()), bool(losses[second] - losses[first] < AMBIGUOUS)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from all rows outside the held-out fold that have a language."""
    schema = "task int, lang string, counts binary"
    rows = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    found = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(_counted, schema)
    found = found.repartition(GROUPS, F.pmod("task", F.lit(GROUPS))).mapInArrow(_added, schema)
    rows = found.repartition(1).mapInArrow(_added, schema).collect()  # a vector of FEATURES counts for each language
    return Model({r.lang: np.frombuffer(r.counts, np.int64) for r in rows})


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: id, held_out, lang_pred, score, ambiguous."""
    small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model or train(docs, id_col, text_col, lang_col))

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.value.predict(t) for t in batch.column(2).to_pylist()]
            langs, scores, unsure = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())], names=["id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id_col)
