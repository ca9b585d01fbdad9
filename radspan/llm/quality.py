"""Quality scores from pairwise preferences (Bradley-Terry).

Each labelled pair of a good and a bad document says that the first is preferred. With a linear worth of the text's
features, the chance of that preference is the logistic function of the difference of the two worths, so the weights
minimise the logistic loss over feature differences (with a small ridge, by Newton steps). The decision threshold is a
quantile of the worths: the share of bad documents among the labelled ones. The score is a logistic function of the
worth, laid so that the quantile has the score THRESHOLD.

Labels come from at most SAMPLE labelled rows outside the held-out fold (by a hash of the id), which bounds what the
driver fits; PARTNERS good documents are paired with each bad one. Texts are always read whole.

Defined cases: a null text counts as empty and gets a score like any other; a null label teaches nothing, of several
labels of an id the smallest counts, of several texts of an id the one with the smallest digest; without both kinds of labels every score is 0.5; rows that repeat stay; an empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import hash_order, small_batches
from radspan.llm.language_id import held_out

SAMPLE, PARTNERS, THRESHOLD, RIDGE = 20_000, 24, 0.3, 1e-3
_CLASSES = np.zeros(256, np.int64)
for _i, _set in enumerate((b" ", b"\n", b"\t\r\x0b\x0c", bytes(range(0x61, 0x7B)), bytes(range(0x41, 0x5B)), b"0123456789", b".,", b"!?", b"*#$%&^~@", b"|<>{}[]=\\/_+", b"'\"-:;()", bytes(range(0x80, 0x100)))):
    _CLASSES[list(_set)] = _i
_N = int(_CLASSES.max()) + 1


def features(text: str) -> np.ndarray:
    """Shares of character classes, and how words, pairs of neighbours and lines vary and repeat; 0 for an empty text."""
    raw = text.encode("utf-8", "replace")
    per_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_CLASSES, per_byte, _N) / max(len(raw), 1)
    words = text.split()
    n = len(words)
    distinct = set(words)
    lines = [x for x in text.split("\n") if x]
    letters = max(kinds[3] + kinds[4], 1e-9)
    more = [
        np.log1p(n),
        len(raw) / max(n, 1) / 10,
        np.log1p(len(distinct)) / max(np.log1p(n), 1e-9),
        sum(map(eq, words, words[1:])) / max(n - 1, 1),
        len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
        sum(map(len, distinct)) / max(len(distinct), 1) / 10,
        1 - len(set(lines)) / max(len(lines), 1),
        n / max(len(lines), 1) / 100 if n < 100 * max(len(lines), 1) else 1.0,
        kinds[4] / letters,
        min(1.0, 20 * kinds[7]),
        min(1.0, 20 * kinds[8]),
        min(1.0, 20 * kinds[9]),
        float(n < 5),
    ]
    return np.concatenate([kinds, np.sqrt(kinds[[4, 5, 7, 8, 9]]), more])


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t or "").tolist() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64())), batch.column(3)], names=["id", "label", "x", "digest"])


class Model:
    """Worth of a text: weights over standardised features; and the worth at the threshold."""

    def __init__(self, x: np.ndarray, good: np.ndarray, partners: int = PARTNERS):
        self.mean = x.mean(0) if len(x) else np.zeros(len(features("")))
        self.scale = np.maximum(x.std(0), 1e-6) if len(x) else np.ones_like(self.mean)
        self.weights, self.cut, self.steep = np.zeros_like(self.mean), 0.0, 0.0
        z = (x - self.mean) / self.scale if len(x) else x
        high, low = np.flatnonzero(good), np.flatnonzero(~good)
        if not len(high) or not len(low):
            return
        pick = np.random.default_rng(1).integers(0, len(high), (len(low), partners))
        d = (z[high[pick]] - z[low][:, None, :]).reshape(-1, z.shape[1])
        for _ in range(40):  # Newton steps on mean(log(1 + exp(-d.w))) + RIDGE / 2 * |w|^2
            p = 1 / (1 + np.exp(np.clip(d @ self.weights, -30, 30)))
            gradient = -(d * p[:, None]).mean(0) + RIDGE * self.weights
            curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(d.shape[1])
            step = np.linalg.solve(curve, gradient)
            step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
            self.weights -= step
            if np.abs(step).max() < 1e-6:
                break
        worth = z @ self.weights
        self.cut = float(np.quantile(worth, len(low) / len(x)))
        self.steep = 1.0

    def score(self, text: str) -> float:
        if not self.steep:
            return 0.5
        worth = float(((features(text) - self.mean) / self.scale) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(self.steep * (worth - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD)), -500, 500))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"))
    some = known.orderBy(hash_order("quality", F.col("id").cast("string")), "id").limit(sample)  # the documented bound of what is fitted
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), "id")
    rows = rows.select("id", "label", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_featured, f"id {kind}, label int, x array<double>, digest string")
    found = found.groupBy("id").agg(F.min("label").alias("label"), F.min_by("x", "digest").alias("x"))
    got = found.orderBy("id").collect()  # at most `sample` rows
    return Model(np.array([r.x for r in got]).reshape(len(got), len(features(""))), np.array([r.label == 1 for r in got], bool))


def scored(docs: DataFrame, labels: DataFrame | None, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, held_out, score, predicted."""
    small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels, id_col=id_col, text_col=text_col))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([known.value.score(t or "") for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.float64()), pa.array((found >= THRESHOLD).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, without the rows whose score is below THRESHOLD."""
    known = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col))
    at = docs.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [known.value.score(t or "") >= THRESHOLD for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
