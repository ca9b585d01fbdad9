"""SimHash near duplicates: fingerprints, bit-sliced comparison inside shared blocks, components.

1. A text's fingerprint has a bit set where more than half of its word shingles (repeats included) have it in their
   XXH64. Rows of one fingerprint are a class; a class is a node, whatever its number of rows.
2. Two fingerprints within the radius differ in at most `radius` of b blocks of bits, so they agree in b - radius whole
   blocks. Every choice of that many blocks is a table of keys; b grows with the number of classes so that a key's
   bucket stays small. Only buckets with two classes or more go on.
3. Buckets are compared bit-sliced: the classes of many buckets lie one after another, plane p holds bit p of 64 of them
   in a word. All pairs at one lag are the planes against themselves, shifted; their distances are added up by
   carry-save counters, a few words of bits for 64 pairs, and a word is abandoned once all its pairs exceed the radius.
   Pairs that are connected already are left out.
4. A bucket beyond a chunk is dealt to chunks and linked in two rounds, as in near_dedup.chunk_links; nothing is capped.
   Large-star and small-star connect the links.

Defined cases: a null text, or one without words, has fingerprint zero and is linked like any other; fewer words than a
shingle count as one shingle; rows that repeat an id are rows of their own; a component is named by its smallest id
that is not null, and by null if it has none; an empty table gives an empty result; other columns are never read. Texts
are read in portions.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import sized, small_batches, work_table
from radspan.llm.components import components
from radspan.llm.near_dedup import LINKS, chunk_links
from radspan.llm.shingles import _pieces

WORDS, RADIUS, BITS, SEED = 3, 3, 64, 42
#: Classes that share a key if fingerprints were even; classes of a chunk; rows that are compared side by side.
FILL, CHUNK, BATCH_ROWS = 64, 1024, 1 << 16
#: Planes between two looks at which words may be abandoned.
LOOK = 8
U = np.uint64
_hash = functools.partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of a whole text as a signed long."""
    last, n, ones = [], 0, np.zeros(BITS, np.int64)
    for piece in _pieces(text.lower()):  # of bytes, lower() touches A-Z only
        last += piece.split()
        shingles = len(last) - words + 1
        if shingles > 0:
            hashes = np.fromiter(map(_hash, map(b" ".join, zip(*[last[k:] for k in range(words)]))), U, shingles)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(shingles, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n, last = n + shingles, last[shingles:]
    if not n:
        return int(np.array([_hash(b" ".join(last)) if last else 0], U).view(np.int64)[0])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def _printed(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t or b"", words) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], names=["id", "mark"])

    return run


def planes(marks: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit marks: row p, word w, bit i is bit p of mark 64 * w + i; one more word of zeros."""
    n = len(marks)
    bits = np.unpackbits(np.ascontiguousarray(marks).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return _lanes(np.concatenate([bits, np.zeros((-n % 64 + 64, BITS), np.uint8)]).T)


def _lanes(bits: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.packbits(bits, axis=-1, bitorder="little")).view(U)


def near_lanes(sliced: np.ndarray, lag: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """The places i, of those wanted (a bit each), where marks i and i + lag differ in at most `radius` bits.

    The counters start so that they overflow just beyond the radius.
    """
    far, shift = divmod(lag, 64)
    digits = radius.bit_length()
    at = np.flatnonzero(wanted)
    live = wanted[at]
    over = np.zeros(len(at), U)
    start = (1 << digits) - 1 - radius
    counters = [np.full(len(at), (1 << 64) - 1 if start >> d & 1 else 0, U) for d in range(digits)]
    for first in range(0, BITS, LOOK):
        for plane in sliced[first : first + LOOK]:
            other = plane[at + far]
            if shift:
                other = (other >> U(shift)) | (plane[at + far + 1] << U(64 - shift))
            carry = plane[at] ^ other
            for d, c in enumerate(counters):
                counters[d], carry = c ^ carry, c & carry
            over |= carry
        live &= ~over
        stay = live != 0
        if not stay.all():  # the others are abandoned
            at, live, over, counters = at[stay], live[stay], over[stay], [c[stay] for c in counters]
        if not len(at):
            break
    bits = np.unpackbits(live.view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return at[row] * 64 + bit


def joined(group: np.ndarray, marks: np.ndarray, label: np.ndarray, side: np.ndarray | None, radius: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) within the radius that connect what is linked inside each group; groups lie one after another.

    label: what is connected already shares a label. side: if given, only pairs of different sides are compared.
    """
    label = np.unique(label, return_inverse=True)[1]
    parent = np.arange(label.max() + 1)

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    last = np.searchsorted(group, group, side="right")  # group numbers ascend
    room, sliced, lag = last - 1 - np.arange(len(group)), planes(marks), 1
    at = np.flatnonzero(room >= lag)
    while len(at):
        some = at[label[at] != label[at + lag]]
        if side is not None:
            some = some[side[some] != side[some + lag]]
        if len(some):
            wanted = np.zeros(sliced.shape[1] * 64, bool)
            wanted[some] = True
            met = False
            for i in near_lanes(sliced, lag, _lanes(wanted), radius):
                a, b = root(label[i]), root(label[i + lag])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    met = True
                    yield int(i), int(i + lag)
            if met:
                while not np.array_equal(parent, parent[parent]):
                    parent = parent[parent]
                label = parent[label]
        lag += 1
        at = at[room[at] >= lag]


def _compared(across: bool, radius: int):
    """Links from rows (key, low, high, id, comp, side) sorted by the first three; id is the mark itself."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def solved(columns: list[np.ndarray]) -> pa.RecordBatch:
            key, low, high, marks, comp, side = columns
            new = (np.diff(key, prepend=key[0]) != 0) | (np.diff(low, prepend=low[0]) != 0) | (np.diff(high, prepend=high[0]) != 0)
            pairs = list(joined(np.cumsum(new), marks, comp if across else np.arange(len(marks)), side if across else None, radius))
            a, b = (marks[[p[k] for p in pairs]] if pairs else marks[:0] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
            if sum(len(h[0]) for h in held) >= BATCH_ROWS:
                columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                differ = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]) | (columns[2] != columns[2][-1]))
                cut = int(differ[-1]) + 1 if len(differ) else 0  # the last group may go on
                held = [[c[cut:] for c in columns]]
                if cut:
                    yield solved([c[:cut] for c in columns])
        if held:
            yield solved([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def masks(classes: int, radius: int = RADIUS) -> list[int]:
    """Masks of key bits, as signed longs: of `blocks` blocks, all but `radius`."""
    blocks = radius + 1
    while blocks < BITS and classes > FILL << (BITS * (blocks - radius) // blocks):
        blocks += 1
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    whole = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    found = [sum(kept) for kept in combinations(whole, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def class_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links a < b that connect the marks (column mark, distinct; a work table) within the radius."""
    keys = F.array(*[F.xxhash64(F.lit(t), F.col("mark").bitwiseAND(F.lit(m))) for t, m in enumerate(masks(classes.count(), radius))])
    dealt = classes.select(F.col("mark").alias("id"), F.explode(keys).alias("key"))
    shared = work_table(dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = work_table(dealt.join(sized(shared), "key").select("key", "id", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "members")

    def solved(rows: DataFrame, across: bool) -> DataFrame:
        every = rows.withColumn("low", F.explode("lows")).withColumn("high", F.explode("highs")).select("key", "low", "high", "id", "comp", "side")
        return every.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "id", "side").mapInArrow(_compared(across, radius), LINKS)

    return chunk_links(members, solved)


def link(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hexadecimal digits), component_id.

    Rows of a frequent fingerprint get their component where they lie: fingerprints with more than a quarter of a
    task's share of rows are broadcast, at most four for each shuffle partition.
    """
    spark = docs.sparkSession
    small_batches(spark)
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = some.schema["id"].dataType.simpleString()
    rows = work_table(some.mapInArrow(_printed(words), f"id {kind}, mark long"), "marks")
    classes = work_table(rows.groupBy("mark").agg(F.min("id").alias("least"), F.count("*").alias("n")), "classes")
    found = work_table(components(class_links(classes, radius)), "found").select(F.col("id").alias("mark"), "component")
    inside = work_table(classes.join(sized(found), "mark"), "inside")
    named = inside.groupBy("component").agg(F.min("least").alias("component_id"))
    named = inside.join(sized(named), "component").select("mark", "component_id", F.lit(True).alias("linked"))
    of = classes.join(named, "mark", "left").select("mark", "n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    of = work_table(of, "components")
    share = max(2, (of.agg(F.sum("n")).first()[0] or 0) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    heavy = of.where(F.col("n") > share).select("mark", "component_id")
    light = of.where(F.col("n") <= share).select("mark", "component_id")
    rest = rows.join(F.broadcast(heavy.select("mark")), "mark", "left_anti")
    out = rows.join(F.broadcast(heavy), "mark").unionByName(rest.join(light, "mark"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")
