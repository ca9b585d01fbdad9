"""Near duplicates: MinHash bands, signature verification, exact confirmation, components.

1. Each row's text becomes its set of word shingles; rows of one set are a class, represented by its first row.
2. Minima of universal hash functions are banded so that a pair at the threshold is missed with a chance below MISS.
   Small buckets give their pairs; large ones are linked chunk by chunk (below). Pairs whose signatures agree too little
   (FIVE standard deviations below the threshold) go.
3. What is left is connected into families. Within a family full sets are compared, again chunk by chunk.
4. Components of the confirmed links are those of all links. No partner, bucket or family is capped.

A group (bucket or family) beyond a chunk is linked in two rounds. First its members are dealt to chunks by a hash, with
a few leaders of the group in every chunk, and each chunk gives a spanning forest of its links; this moves every member
once. Large-star and small-star then contract the forests. In groups that are still in several components, only the
members outside the largest component meet all others, in pairs of chunks; members of one component are not compared
again. So copies that link cost their number, and only texts that agree by signature without being linked are compared
one by one.

Defined cases: a null text, or one without words, has the empty set and is linked with nothing; fewer words than a
shingle count as one shingle; rows that repeat an id, or have none, are rows of their own, and a component is named by
its smallest id that is not null; an empty table gives an empty result; other columns are never read by link(), and
kept as they are by keep_first().
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import numbered, sized, small_batches, with_group, work_table
from radspan.llm.components import components
from radspan.llm.shingles import MinHash, U, mix, shingle_sets

WORDS, PERCENT = 5, 80
MISS, FIVE = 1e-6, 5
#: Members of a bucket that gives its pairs outright; members of a chunk; bytes of the full sets of a chunk; leaders.
SMALL, CHUNK, SET_BYTES, LEADERS = 16, 256, 8 << 20, 4
MARKS = "row long, id long, n_shingles long, s1 long, s2 long, signature binary, bands array<long>"
LINKS = "a long, b long"

#: near(i, others): which of the others are linked with i, for the values that it was made from.
Near = Callable[[int, np.ndarray], np.ndarray]


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows of a band."""
    rows = 6 if percent >= 85 else 5
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows)), rows


def _least_agreement(percent: int, hashes: int) -> float:
    t = percent / 100
    return t - FIVE * math.sqrt(t * (1 - t) / hashes)


def _marked(words: int, percent: int) -> Callable:
    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinHash(*banding(percent))

        def rows(row: list, ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            full = [s for s in sets if len(s)]
            signature, bands = hashing.marks(full) if full else (None, None)
            n = np.array([len(s) for s in sets], np.int64)
            s1, s2, marks, numbers, at = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64), [], [], 0
            if full:
                x, starts = np.concatenate(full), np.cumsum([0, *[len(s) for s in full[:-1]]])
                s1[n > 0] = np.add.reduceat(x, starts).astype(np.int64)
                s2[n > 0] = np.add.reduceat(mix(x ^ U(0x5851F42D4C957F2D)), starts).astype(np.int64)
            for s in sets:
                marks.append(signature[at].tobytes() if len(s) else None)
                numbers.append(bands[at] if len(s) else None)
                at += len(s) > 0
            return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(ids, pa.int64()), pa.array(n), pa.array(s1), pa.array(s2), pa.array(marks, pa.binary()), pa.array(numbers, pa.list_(pa.int64()))], names=["row", "id", "n_shingles", "s1", "s2", "signature", "bands"])

        for batch in batches:
            row, kept, sets, size = [], [], [], 0
            for r, i, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2).cast(pa.binary()).to_pylist(), words), strict=True):
                row.append(r)
                kept.append(i)
                sets.append(s)
                size += len(s)
                if size >= 1 << 16:
                    yield rows(row, kept, sets)
                    row, kept, sets, size = [], [], [], 0
            if kept:
                yield rows(row, kept, sets)

    return mark


def _agreeing(least: float) -> Callable:
    """Pairs a, b whose signatures agree."""

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                good = pa.array((left == right).mean(1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return agree


def _by_signature(least: float) -> Callable[[list[bytes]], Near]:
    def made(values: list[bytes]) -> Near:
        marks = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
        return lambda i, others: (marks[others] == marks[i]).mean(1) >= least

    return made


def _by_sets(percent: int) -> Callable[[list[bytes]], Near]:
    def made(values: list[bytes]) -> Near:
        sets = [np.frombuffer(v, U) for v in values]
        size = np.array([len(s) for s in sets])

        def near(i: int, others: np.ndarray) -> np.ndarray:
            out = (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])) & (size[others] > 0)
            some = np.flatnonzero(out)
            if len(some) and size[i]:
                own, x = sets[i], np.concatenate([sets[j] for j in others[some]])
                hit = own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x
                common = np.add.reduceat(hit, np.cumsum([0, *size[others[some]][:-1]]), dtype=np.int64)
                out[some] = 100 * common >= percent * (size[others[some]] + size[i] - common)
            return out & bool(size[i])

        return near

    return made


def _forest(ids: list, comps: list, sides: list, near: Near) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among all members."""
    left = np.arange(len(ids))
    while len(left):
        wait, left = [left[0]], left[1:]
        while wait and len(left):
            i = wait.pop()
            found = near(i, left)
            for j in left[found]:
                yield int(i), int(j)
                wait.append(j)
            left = left[~found]


def _across(ids: list, comps: list, sides: list, near: Near) -> Iterator[tuple[int, int]]:
    """Links between members of side 1 and of side 0 that join components, one for each two that meet."""
    part, side = np.unique(np.array(comps), return_inverse=True)[1], np.array(sides)
    for i in np.flatnonzero(side == 1):
        others = np.flatnonzero((part != part[i]) & (side == 0))
        found = others[near(i, others)] if len(others) else others
        for other in np.unique(part[found]):
            yield int(i), int(found[part[found] == other][0])
            part[part == other] = part[i]


def _grouped(solve: Callable, made: Callable[[list[bytes]], Near]) -> Callable:
    """Runs solve on each group of rows (key, low, high, id, comp, side, value), sorted by the first three columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def solved() -> pa.RecordBatch:
            ids, comps, sides, values = zip(*rows, strict=True)
            links = [(ids[i], ids[j]) for i, j in solve(ids, comps, sides, made(values)) if ids[i] != ids[j]]
            return pa.RecordBatch.from_pydict({"a": pa.array([min(x) for x in links], pa.int64()), "b": pa.array([max(x) for x in links], pa.int64())})

        for batch in batches:
            for *key, i, comp, side, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != at:
                    if len(rows) > 1:
                        yield solved()
                    at, rows = key, []
                rows.append((i, comp, side, value))
        if len(rows) > 1:
            yield solved()

    return run


def _solved(rows: DataFrame, attach: Callable[[DataFrame], DataFrame], solve: Callable, made: Callable) -> DataFrame:
    """Links from rows (key, low, high, id, comp, side): attach() gives each id its value once, then the row goes to all its
    groups (lows and highs are arrays)."""
    every = attach(rows).withColumn("low", F.explode("lows")).withColumn("high", F.explode("highs")).select("key", "low", "high", "id", "comp", "side", "value")
    return every.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "id", "side").mapInArrow(_grouped(solve, made), LINKS)


def _solver(attach: Callable[[DataFrame], DataFrame], made: Callable[[list[bytes]], Near]) -> Callable[[DataFrame, bool], DataFrame]:
    """For chunk_links(): attach(rows) adds the column `value` by id; made(values) tells which values are linked."""
    return lambda rows, across: _solved(rows, attach, _across if across else _forest, made)


def _place(chunks: Column) -> Column:
    return F.pmod(F.xxhash64("id"), chunks).cast("int")


def chunk_links(members: DataFrame, solved: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """Links that connect what is linked within each group; members: a work table of key, id, chunks (of the group).

    solved(rows, across) gives links a, b that connect what is linked in each cell of rows (key, lows, highs, id, comp,
    side): among all its members, or across, between sides 0 and 1 of different comp.
    """
    none, zero = F.lit(None).cast("long"), F.lit(0)
    dealt = members.select("key", "id", none.alias("comp"), zero.alias("side"), F.array(_place(F.col("chunks"))).alias("lows"), F.array(zero).alias("highs"))
    big = members.where("chunks > 1")
    if big.isEmpty():
        return solved(dealt, False)
    first = [F.min("id"), *[F.min_by("id", F.xxhash64("id", F.lit(k))) for k in range(1, LEADERS)]]
    leaders = big.groupBy("key", "chunks").agg(F.array_distinct(F.array(*first)).alias("ids")).select("key", "chunks", F.explode("ids").alias("id"))
    others = F.array_remove(F.sequence(zero, F.col("chunks") - 1), _place(F.col("chunks")))
    dealt = dealt.unionByName(leaders.select("key", "id", none.alias("comp"), zero.alias("side"), others.alias("lows"), F.array(zero).alias("highs")))
    links = work_table(solved(dealt, False), "links")

    found = components(links)
    parts = work_table(big.join(sized(found), "id", "left").select("key", "id", "chunks", F.coalesce("component", "id").alias("comp")), "parts")
    sizes = parts.groupBy("key", "chunks", "comp").agg(F.count("*").alias("n"))
    apart = sizes.groupBy("key", "chunks").agg(F.max_by("comp", "n").alias("top"), F.max("n").alias("most"), F.sum("n").alias("n")).where("n > most")
    apart = work_table(apart.select("key", "top", F.ceil(F.col("chunks") * (F.col("n") - F.col("most")) / F.col("n")).cast("int").alias("few")), "apart")
    if apart.isEmpty():
        return links
    parts = parts.join(sized(apart), "key").withColumn("out", F.col("comp") != F.col("top"))
    few, many = F.sequence(zero, F.col("few") - 1), F.sequence(zero, F.col("chunks") - 1)
    met = parts.select("key", "id", "comp", zero.alias("side"), few.alias("lows"), F.array(_place(F.col("chunks"))).alias("highs"))
    out = parts.where("out").select("key", "id", "comp", F.lit(1).alias("side"), F.array(_place(F.col("few"))).alias("lows"), many.alias("highs"))
    return links.unionByName(solved(met.unionByName(out), True))


def _candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Links a < b between nodes that share a bucket and whose signatures agree: all of small buckets, connecting ones of large ones."""
    bands, rows = banding(percent)
    least = _least_agreement(percent, bands * rows)
    dealt = nodes.select("id", F.explode("bands").alias("h"))
    shared = work_table(dealt.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = work_table(dealt.join(sized(shared), "h"), "members")
    small = members.where(F.col("n") <= SMALL).groupBy("h").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    pairs = small.select(F.expr(f"explode(flatten(transform(ids, (a, i) -> transform(slice(ids, i + 2, {SMALL}), b -> struct(a, b)))))").alias("p")).select("p.a", "p.b").distinct()
    left, right = (nodes.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    pairs = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_agreeing(least), LINKS)
    large = members.where(F.col("n") > SMALL).select(F.col("h").alias("key"), "id", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    signatures = nodes.select("id", F.col("signature").alias("value"))
    return pairs.unionByName(chunk_links(large, _solver(lambda rows: rows.join(signatures, "id"), _by_signature(least))))


def _sets_of(words: int) -> Callable:
    """The first column, a text, becomes its set as the last one."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shingle_sets(batch.column(0).cast(pa.binary()).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([s.tobytes() for s in found], pa.binary())], names=[*batch.schema.names[1:], "value"])

    return sets


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """docs: a work table of row, id, text. One row per row: row, id, n_shingles, component_id, first (the row of the component that stays)."""
    marks = work_table(docs.select("row", F.col("id").cast("long").alias("id"), "text").mapInArrow(_marked(words, percent), MARKS), "marks")
    some = marks.where("n_shingles > 0").select("row", "id", "n_shingles", F.concat_ws(":", "n_shingles", "s1", "s2").alias("set"))
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row")))
    of = with_group(work_table(some, "sets"), "set", [smallest.alias("least")]).select("row", "id", "n_shingles", "least")
    of = work_table(of, "classes")
    reps = work_table(of.where("row = least.row").select(F.col("row").alias("id"), "least"), "reps")
    nodes = marks.select(F.col("row").alias("id"), "n_shingles", "signature", "bands")
    nodes = work_table(nodes.join(sized(reps.select("id")), "id", "left_semi"), "nodes")

    families = work_table(components(_candidates(nodes, percent)), "families").withColumnRenamed("component", "key")
    weights = families.join(nodes.select("id", "n_shingles"), "id").groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK, F.col("s") * 8 / SET_BYTES)).cast("int").alias("chunks")
    members = work_table(families.join(sized(weights.select("key", chunks)), "key").select("key", "id", "chunks"), "members")
    texts = docs.select(F.col("row").alias("id"), "text")

    def attach(rows: DataFrame) -> DataFrame:
        both = texts.join(sized(rows), "id").select("text", *rows.columns)
        return both.mapInArrow(_sets_of(words), f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, value binary")

    found = components(chunk_links(members, _solver(attach, _by_sets(percent))))
    # the least of each component, over the representatives of its classes
    named = work_table(found.join(reps, "id"), "named")
    least = named.groupBy("component").agg(F.min("least").alias("all"))
    named = work_table(named.join(sized(least), "component").select(F.col("id").alias("node"), "all"), "components")
    of = of.join(sized(named), F.col("least.row") == F.col("node"), "left").withColumn("all", F.coalesce("all", "least"))
    alone = marks.where("n_shingles = 0").select("row", "id", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("first"))
    return of.select("row", "id", "n_shingles", F.col("all.id").alias("component_id"), (F.col("row") == F.col("all.row")).alias("first")).unionByName(alone)


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (smallest id reachable), kept (id = component_id), first (the
    one row of the component that stays)."""
    small_batches(docs.sparkSession)
    copy = work_table(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), "texts")
    made = _linked(copy, words, percent)
    return made.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "first")


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with one row of each component."""
    small_batches(docs.sparkSession)
    copy, row = numbered(docs)
    made = _linked(copy.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), words, percent)
    gone = work_table(made.where(~F.col("first")).select(F.col("row").alias(row)), "gone")
    return copy.join(sized(gone), row, "left_anti").drop(row)
