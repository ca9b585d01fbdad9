"""Best-fit packing by sums of squares.

A document's ids (with an end id) are one piece if they fit a sequence; longer ones are cut into full sequences, the
first piece taking what is left over. A full piece is a sequence of its own. The other pieces, one a document at most,
are dealt by a hash of their row to groups of about GROUP_ROWS documents, and each group is packed longest first: a piece goes where
the sum over all residual gaps of the squared number of open sequences with that gap becomes smallest; a new sequence
is opened only where none has room. A group holds lengths and places only; the ids stay where they are until
sequences() is asked for.

Defined cases: a null text is empty and packs its end id alone; rows that repeat an id, or have none, are packed each;
ties go to the smallest gap and, between pieces of one length, to the smaller id; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import small_batches, work_table
from radspan.llm.tokens import gathered, id_encoder

CAPACITY, END_ID = 2048, 0
GROUP_ROWS = 1 << 16
#: Up to so many groups; beyond them groups grow to GREATEST_GROUP rows, and only then there are more.
GROUPS, GREATEST_GROUP = 4096, 1 << 20
#: Ids of pieces that go out in one batch, about.
BATCH_IDS = 1 << 22


def _cut(ids: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """For documents of these sizes that lie one after another in ids: of each piece its document, number, start and length."""
    n = -(-sizes // capacity)
    of = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    first = (sizes - 1) % capacity + 1
    start = np.where(number > 0, first[of] + (number - 1) * capacity, 0)
    return of, number, start, np.where(number > 0, capacity, first[of])


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, row (a number of the row of docs), piece, start (ids of the document before it), length, ids
    (little-endian unsigned 32-bit)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, row = id_encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        for batch in gathered(batches, 1):
            for first, found, sizes in encoder.encode_column(batch.column(1)):
                ids, ends = np.insert(found, np.cumsum(sizes), end_id).astype("<u4"), np.cumsum(sizes + 1)
                of, number, start, length = _cut(ids, sizes + 1, capacity)
                bounds = np.concatenate([[0], np.cumsum(length)])
                of_row = batch.column(0).slice(first, len(ends))
                for a, b in _runs(bounds):
                    raw = pa.py_buffer(ids[bounds[a] : bounds[b]])
                    offsets = pa.py_buffer(((bounds[a : b + 1] - bounds[a]) * 4).astype(np.int32))
                    packed = pa.Array.from_buffers(pa.binary(), b - a, [None, offsets, raw])
                    yield pa.RecordBatch.from_arrays([of_row.take(pa.array(of[a:b])), pa.array(row + of[a:b]), pa.array(number[a:b].astype(np.int32)), pa.array(start[a:b]), pa.array(length[a:b]), packed], names=["id", "row", "piece", "start", "length", "ids"])
                row += len(ends)

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, row long, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def _runs(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of pieces of about BATCH_IDS ids."""
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + BATCH_IDS, side="right")) - 1)
        yield a, b
        a = b


def sum_of_squares(lengths: Iterable[int], capacity: int) -> tuple[list[int], list[int]]:
    """The sequence and offset of each length, in the order given."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, used, never = [], [], 0, np.iinfo(np.int64).max
    for s in lengths:
        gap = capacity
        if s < capacity:
            have = count[s:capacity]  # by the gap g before, from s on; the piece makes it g - s
            change = np.where(have > 0, 2 * (count[: capacity - s] - have) + 2, never)
            if have[0]:
                change[0] = 1 - 2 * have[0]  # a sequence that gets full counts no more
            best = int(change.argmin())
            if have[best]:
                gap = best + s
        if gap == capacity:  # a new sequence, as none has room
            place, used = used, used + 1
        else:
            place = open_by_gap[gap].pop()
            count[gap] -= 1
        sequence.append(place)
        offset.append(capacity - gap)
        if gap > s:
            open_by_gap[gap - s].append(place)
            count[gap - s] += 1
    return sequence, offset


def place(rows: DataFrame, groups: int, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """rows (id, row, piece, start, length and other small columns) with sequence_id and offset; dealt by the number of the
    row, so that rows that agree in all else are spread."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, sequence_id long, offset long"
    length = rows.columns.index("length")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        used, held = TaskContext.get().partitionId() << 40, []

        def placed(table: pa.Table, sequence: np.ndarray, offset: np.ndarray) -> Iterator[pa.RecordBatch]:
            table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
            yield from table.combine_chunks().to_batches(max_chunksize=50_000)

        for batch in batches:  # longest first, so full pieces come before all others and need not be held
            full = int((batch.column(length).to_numpy() == capacity).sum())
            if full:
                yield from placed(pa.Table.from_batches([batch.slice(0, full)]), np.arange(used, used + full), np.zeros(full, np.int64))
                used += full
            if full < batch.num_rows:
                held.append(batch.slice(full))
        if held:
            table = pa.Table.from_batches(held)
            sequence, offset = sum_of_squares(table.column(length).to_pylist(), capacity)
            yield from placed(table, np.asarray(sequence, np.int64) + used, np.asarray(offset, np.int64))

    dealt = rows.repartition(groups, "row", "piece")
    return dealt.sortWithinPartitions(F.desc("length"), id_col, "piece", "row").mapInArrow(pack, schema)


def n_groups(rows: int) -> int:
    """Groups for so many documents: what a group gathers comes from every map task, so their number is held down."""
    return max(1, min(GROUPS, math.ceil(rows / GROUP_ROWS)), math.ceil(rows / GREATEST_GROUP))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    rows = rows.select(id_col, "row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(rows, n_groups(docs.count()), capacity, id_col).drop("row")


def sequences(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary), pieces (id, start, length, offset).

    The pieces wait in a work table, where each has the number of its row: rows that repeat an id stay apart.
    """
    found = work_table(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    placed = place(found.drop("ids"), n_groups(docs.count()), capacity, id_col).select("row", "piece", "sequence_id", "offset")
    both = found.join(placed, ["row", "piece"]).select("sequence_id", F.struct("offset", F.col(id_col).alias("id"), "start", "length", "ids").alias("p"))
    both = both.groupBy("sequence_id").agg(F.array_sort(F.collect_list("p")).alias("p"))  # at most `capacity` ids
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return both.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: F.struct(x["id"].alias(id_col), x["start"].alias("start"), x["length"].alias("length"), x["offset"].alias("offset"))).alias("pieces"))
