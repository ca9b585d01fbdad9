"""Exact top-k inner products over norm buckets.

Vectors become integers, floor(1024 * x). Candidates are sorted by length, longest first, and cut by range (length,
then id, so equal lengths are spread) into buckets; queries lie in blocks. First each block meets the bucket of the
longest vectors, which gives every query a score that its k-th result must reach. A bucket whose longest vector cannot
reach it for any query of a block is never joined to that block. Inside a bucket, for slices of similar length, the
local cosine threshold (score to reach over the product of the query's and the longest length) decides: above 1 the
query skips the slice; from COORDINATE on, coordinates prune, as a vector at that cosine must have the query's largest
coordinates within known bounds; below, length prunes, as only a prefix of the slice is long enough. What is left is
verified by exact products, and the score to reach rises with what is found.

Defined cases: vectors that are null, empty, hold null or non-finite components or differ in dimension from the query
take no part; rows that repeat an id are candidates each, except for the query of that id; ties go to the smaller id; with
fewer candidates than k all come back; scores beyond a long are clipped to it; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.llm.common import sized, small_batches, work_table

SCALE = 1024
K, EVERY = 10, 100
#: Vectors of a bucket, queries of a block, vectors of a slice.
BUCKET, QUERIES, SLICE = 32_768, 1024, 2048
#: Bytes of a block's matrix at most, whatever its dimension.
BLOCK_BYTES = 64 << 20
#: Cosine from which coordinates prune, and how many of them.
COORDINATE, COORDINATES = 0.6, 4
#: Beyond this size of a component, products are summed as Python integers instead of doubles.
EXACT = 1 << 20
_LONG = (1 << 63) - 1


def _integers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, d, norm and the integer components (little-endian doubles, exact) of the vectors that take part."""
    for batch in batches:
        ids, norms, sizes, packed = [], [], [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
                continue
            whole = np.floor(np.asarray(v, np.float64) * SCALE)
            if np.isfinite(whole).all():
                ids.append(i)
                sizes.append(len(v))
                norms.append(float(np.sqrt(np.square(whole / (top := max(1.0, np.abs(whole).max()))).sum()) * top))
                packed.append(whole.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(norms, pa.float64()), pa.array(packed, pa.binary())], names=["id", "d", "norm", "v"])


def _blocked(most: int):
    """Packs runs of rows of one dimension into blocks: part, d, longest, ids, norms, matrix."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, d, rows, held = TaskContext.get().partitionId(), 0, None, [], 0

        def packed() -> pa.RecordBatch:
            ids, norms = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows])
            return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + number], pa.int64()), "d": pa.array([d], pa.int32()), "longest": pa.array([norms.max()]), "ids": pa.array([ids.tobytes()], pa.binary()), "norms": pa.array([norms.tobytes()], pa.binary()), "matrix": pa.array([b"".join(r[2] for r in rows)], pa.binary())})

        for batch in batches:
            for i, size, norm, v in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and (size != d or len(rows) == most or held + len(v) > BLOCK_BYTES):
                    yield packed()
                    number, rows, held = number + 1, [], 0
                d = size
                held += len(v)
                rows.append((i, norm, v))
        if rows:
            yield packed()

    return block


_BLOCK = "block long, d int, longest double, ids binary, norms binary, matrix binary"


def _products(q: np.ndarray, v: np.ndarray, plain: bool) -> np.ndarray:
    """Exact inner products of rows of q and v."""
    if plain:  # all partial sums are whole numbers below 2 ** 53
        return (q @ v.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in q.tolist()], object) @ np.array([[int(x) for x in r] for r in v.tolist()], object).T
    return np.clip(big, -_LONG - 1, _LONG).astype(np.int64)


def _plain(q: np.ndarray, v: np.ndarray) -> bool:
    return float(np.abs(q).max()) < EXACT and float(np.abs(v).max()) < EXACT and q.shape[1] < 1 << 12


def search_block(qids, q, qnorm, floor, vids, v, vnorm, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score): for each query at least those of its k best in this block whose score reaches `floor`.

    v is sorted by length, longest first. floor: scores that results must reach, as doubles (-inf: none).
    """
    best = [[] for _ in qids]  # (-score, id), the k best so far
    plain = _plain(q, v)
    unit_q = q / np.maximum(qnorm, 1e-300)[:, None]
    top = np.argsort(-np.abs(unit_q), axis=1)[:, :COORDINATES]
    for a in range(0, len(vids), SLICE):
        block, norms, ids = v[a : a + SLICE], vnorm[a : a + SLICE], vids[a : a + SLICE]
        longest = max(norms[0], 1e-300)
        with np.errstate(all="ignore"):
            cosine = np.where(np.isfinite(floor), floor / np.maximum(qnorm * longest, 1e-300), -np.inf) - 1e-9
        live = np.flatnonzero(cosine <= 1)
        if not len(live):
            continue
        by_length = live[cosine[live] < COORDINATE]
        if len(by_length):  # queries together, up to the longest prefix that one of them needs
            with np.errstate(all="ignore"):
                need = np.where(floor[by_length] > 0, floor[by_length] / np.maximum(qnorm[by_length], 1e-300) * (1 - 1e-9), 0.0)
            prefix = np.searchsorted(-norms, -need, side="right")
            scores = _products(q[by_length], block[: prefix.max()], plain)
            for j, i in enumerate(by_length):
                _offer(best[i], scores[j, : prefix[j]], ids[: prefix[j]], qids[i], k, floor, i)
        unit = None
        for i in live[cosine[live] >= COORDINATE]:
            if unit is None:
                unit = block / np.maximum(norms, 1e-300)[:, None]
            keep = np.ones(len(ids), bool)
            c = max(0.0, cosine[i])
            for f in top[i]:
                x = unit_q[i, f]
                slack = math.sqrt(max(0.0, (1 - c * c) * (1 - x * x))) + 1e-9
                # between the angles arccos(x) +- arccos(c); open where the axis itself lies within
                if x < c:
                    keep &= unit[:, f] <= x * c + slack
                if -x < c:
                    keep &= unit[:, f] >= x * c - slack
            some = np.flatnonzero(keep)
            if len(some):
                _offer(best[i], _products(q[i : i + 1], block[some], plain)[0], ids[some], qids[i], k, floor, i)
    return [(int(qids[i]), x, -s) for i, found in enumerate(best) for s, x in found]


def _offer(found: list, scores: np.ndarray, ids: np.ndarray, own: int, k: int, floor: np.ndarray, i: int) -> None:
    """Merges scored ids into the k best of query i and raises its floor."""
    reach = scores >= floor[i] if np.isfinite(floor[i]) else np.ones(len(scores), bool)
    reach &= ids != own
    scores, ids = scores[reach], ids[reach]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[scores >= least], ids[scores >= least]
        order = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[order], ids[order]
    found.extend((-int(s), int(x)) for s, x in zip(scores, ids, strict=True))
    found.sort()
    del found[k:]
    if len(found) == k:
        floor[i] = max(floor[i], float(-found[-1][0]))


def _searched(k: int):
    """Rows: queries (ids, norms, matrix), floors, candidates (ids, norms, matrix), d."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                d = row["d"]
                q, v = (np.frombuffer(row[c], np.float64).reshape(-1, d) for c in ("q_matrix", "c_matrix"))
                ids = [np.frombuffer(row[c], np.int64) for c in ("q_ids", "c_ids")]
                norms = [np.frombuffer(row[c], np.float64) for c in ("q_norms", "c_norms")]
                floor = np.frombuffer(row["floors"], np.float64).copy() if row["floors"] else np.full(len(q), -np.inf)
                found = search_block(ids[0], q, norms[0], floor, ids[1], v, norms[1], k)
                cols = list(zip(*found, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return search


_FOUND = "query_id long, vec_id long, score long"


def _joined(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """pairs: q_block, c_block."""
    q = queries.select(F.col("block").alias("q_block"), "d", F.col("ids").alias("q_ids"), F.col("norms").alias("q_norms"), F.col("matrix").alias("q_matrix"), "floors")
    c = blocks.select(F.col("block").alias("c_block"), F.col("ids").alias("c_ids"), F.col("norms").alias("c_norms"), F.col("matrix").alias("c_matrix"))
    return pairs.join(q, "q_block").join(c, "c_block").select("d", "q_ids", "q_norms", "q_matrix", "floors", "c_ids", "c_norms", "c_matrix").mapInArrow(_searched(k), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; a window sees k rows from each bucket that was not pruned."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floored(queries: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Query blocks with the score each of their queries must reach."""
    kth = _ranked(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    of = queries.select("block", F.col("ids").alias("packed"))

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(packed, np.int64)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block] * len(ids), pa.int64()), "place": pa.array(range(len(ids)), pa.int32()), "id": pa.array(ids)})

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, floors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.array([x["floor"] for x in floors])
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "floors": pa.array([values.tobytes()], pa.binary()), "lowest": pa.array([values.min()])})

    floors = of.mapInArrow(unpack, "block long, place int, id long").join(kth, "id", "left")
    floors = floors.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))).alias("f"))  # at most QUERIES
    floors = floors.mapInArrow(pack, "block long, floors binary, lowest double")
    return queries.drop("floors").join(floors, "block")


def search(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", bucket: int = BUCKET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each vector of `queries` its k best among `vectors`, its own id left out."""
    small_batches(vectors.sparkSession)
    schema = "id long, d int, norm double, v binary"
    whole = lambda df: df.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(_integers, schema)
    rows = work_table(whole(vectors), "vectors")
    n = max(1, math.ceil(rows.count() / bucket))
    sort = [F.asc("d"), F.desc("norm"), F.asc("id")]
    blocks = rows.repartitionByRange(n, *sort).sortWithinPartitions(*sort).mapInArrow(_blocked(bucket), _BLOCK)
    blocks = work_table(blocks, "buckets")
    asked = whole(queries).repartitionByRange("d", "id").sortWithinPartitions("d", "id").mapInArrow(_blocked(QUERIES), _BLOCK)
    asked = work_table(asked.withColumn("floors", F.lit(None).cast("binary")), "queries")
    heads = blocks.groupBy("d").agg(F.max_by("block", F.struct("longest", -F.col("block"))).alias("c_block"))
    first = asked.select(F.col("block").alias("q_block"), "d").join(heads, "d").select("q_block", "c_block")
    asked = work_table(_floored(asked, _joined(first, asked, blocks, k), k), "floored")
    # blocks of queries meet buckets block by block, and only where the longest vectors of both reach the lowest floor
    q = asked.select(F.col("block").alias("q_block"), "d", F.col("longest").alias("q_longest"), "lowest")
    c = blocks.select(F.col("block").alias("c_block"), "d", F.col("longest").alias("c_longest"))
    pairs = q.join(sized(c), "d").where(F.col("q_longest") * F.col("c_longest") * (1 + 1e-9) >= F.col("lowest")).select("q_block", "c_block")
    found = _ranked(_joined(pairs, asked, blocks, k), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
