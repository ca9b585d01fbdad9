"""Sharding ordered atomic groups into k contiguous shards of minimal largest size.

Groups of equal texts are laid out in the order of their smallest id. With prefix sums of the group sizes, a
capacity is feasible if k greedy steps (each taking as many whole groups as fit) reach the end. The smallest feasible
capacity is found by binary search. The driver searches in a summary of the prefix sums of at most SLICES slices, and
asks for a finer one where the summary leaves the answer open, so the number of jobs hardly grows with the input. The
cuts are then those of the greedy walk. DataFrame functions only.

Defined cases: a null text has no bytes and is grouped with the empty text; a null id sorts first; rows that repeat
an id stay separate rows of their group; a group is never split, so a shard may be empty when one group outweighs the
others; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import clean_text, ordered_prefix, with_group, work_table

#: So many slices describe the group ends in each round.
SLICES = 4096

Slice = tuple[int, int, int]  # first end, last end, number of ends in it


def _slices(ends: DataFrame, spans: list[tuple[int, int]]) -> list[Slice]:
    """The ends inside the spans, each span in equal slices: at most SLICES + len(spans) rows come back."""
    number, place = F.lit(None), F.lit(None)
    for i, (a, b) in enumerate(spans):
        inside = F.col("end").between(a, b)
        width = max(1, -(-(b - a + 1) * len(spans) // SLICES))
        number = F.when(inside, F.lit(i)).otherwise(number)
        place = F.when(inside, F.floor((F.col("end") - a) / width)).otherwise(place)
    rows = ends.select("end", number.cast("int").alias("span"), place.cast("long").alias("slice")).where("span is not null")
    rows = rows.groupBy("span", "slice").agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n"))
    return sorted((r.a, r.b, r.n) for r in rows.collect())


def _reach(known: list[Slice], place: int) -> tuple[int, int]:
    """Bounds of the last end at or before `place`: equal where the slices tell it exactly."""
    i = bisect.bisect_right(known, place, key=lambda x: x[0]) - 1
    if i < 0:
        return 0, 0
    a, b, n = known[i]
    return (b, b) if b <= place else (a, a) if n <= 2 else (a, place)


def _walk(known: list[Slice], capacity: int, k: int, hopeful: bool) -> list[int]:
    """The places of k greedy steps, each as far as it surely (or, if hopeful, possibly) goes."""
    at = [0]
    for _ in range(k):
        at.append(_reach(known, at[-1] + capacity)[hopeful])
    return at


def smallest_capacity(ends: DataFrame, k: int, total: int, largest: int) -> tuple[int, list[int]]:
    """The smallest capacity with which k greedy steps cover the groups that end at `ends.end`, and the places reached.

    The binary search runs on a summary of the ends, once with what is sure and once with what is possible. Where the
    two differ, the slices in which a step may end are summarised again, finer: one aggregate a round.
    """
    known = _slices(ends, [(1, total)])
    while True:
        found = []
        for hopeful in (True, False):
            low, high = max(-(-total // k), largest), total
            while low < high:
                mid = (low + high) // 2
                low, high = (low, mid) if _walk(known, mid, k, hopeful)[-1] >= total else (mid + 1, high)
            found.append(low)
        low, high = found
        sure, possible = _walk(known, low, k, False), _walk(known, high, k, True)
        if low == high and sure == possible:
            return high, sure[1:]
        again = set()
        for a, b in zip(sure[:-1], possible[:-1], strict=True):
            first, last = (bisect.bisect_right(known, t, key=lambda x: x[0]) - 1 for t in (a + low, b + high))
            again |= {i for i in range(max(0, first), last + 1) if known[i][2] > 2}
        spans = []
        for i in sorted(again):
            if spans and spans[-1][2] == i - 1:
                spans[-1] = (spans[-1][0], known[i][1], i)
            else:
                spans.append((known[i][0], known[i][1], i))
        fresh = _slices(ends, [x[:2] for x in spans])
        # between two marked slices of a span lie only those of two ends or fewer, which are read again with it
        known = sorted({x for i, x in enumerate(known) if i not in again} | set(fresh))


def shard(docs: DataFrame, k: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, size (UTF-8 bytes + 1), text_crc32, law, shard (0 to k-1), slot (gapless from 0), grown_shard."""
    if k < 1:
        raise ValueError("k must be at least 1")
    text = clean_text(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("crc"), F.sha2(text, 256).alias("sha"))
    rows = work_table(rows, "sizes")
    first = F.min(F.struct(F.col("id").isNotNull().alias("some"), F.col("id"))).alias("first")
    rows = with_group(rows, "sha", [first]).select("id", "size", "crc", "sha", F.col("first.id").alias("group"))
    rows = work_table(ordered_prefix(rows, ["group", "sha", "id"], ["size"]), "placed")
    groups = rows.groupBy("group", "sha").agg(F.min("before_size").alias("start"), F.sum("size").alias("size"))
    ends = work_table(groups.select((F.col("start") + F.col("size")).alias("end"), "size"), "ends")
    total, largest = ends.agg(F.max("end"), F.max("size")).first()
    cuts = smallest_capacity(ends, k, total, largest)[1] if total else []
    # cuts lie between groups, so all rows of a group get one number
    number = sum(((F.col("before_size") >= c).cast("int") for c in cuts[:-1]), F.lit(0))
    rows = rows.withColumn("shard", number.cast("int"))
    starts = {r["shard"]: r["r"] for r in rows.groupBy("shard").agg(F.min("rank").alias("r")).collect()}  # k rows
    begin = F.coalesce(*[F.when(F.col("shard") == s, F.lit(r)) for s, r in starts.items()], F.lit(0))
    return rows.select(F.col("id").alias(id_col), "size", F.col("crc").cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("rank") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
