"""Token counts by a map-side lookup in two tiers.

One pass over all texts finds frequent units (words between spaces): each task keeps a Misra-Gries summary of bounded
size, the summaries are merged in a tree of two levels, and the merged table, at most FREQUENT units with their token
counts, is broadcast as two packed buffers. Counting then never moves a unit: a worker looks each unit up in the table,
and encodes what is missing there through a cache of its own. The table only saves time; counts are those of the
library whatever it holds.

Defined cases: a null text counts as empty and has 0 bytes and 0 tokens; texts of any length are counted whole; rows
that repeat stay; tasks without any unit (no rows, empty texts) hand on nothing; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import small_batches
from radspan.llm.tokens import KEEP_LENGTH, LengthCounter, portions

LIMIT = 4096
FREQUENT = 1 << 16
#: Units that a task hands on, and groups of tasks of the first merge.
SUMMARY, GROUPS = 1 << 14, 64


def _trim(counts: Counter, most: int) -> Counter:
    """Misra-Gries for a full summary: the count of the first unit beyond `most` is taken from all."""
    if len(counts) <= most:
        return counts
    least = sorted(counts.values(), reverse=True)[most]
    return Counter({k: v - least for k, v in counts.items() if v > least})


def _emit(counts: Counter, task: int) -> pa.RecordBatch:
    units = sorted(counts)
    return pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "units": pa.array([" ".join(units)]), "counts": pa.array([array("q", [counts[u] for u in units]).tobytes()], pa.binary())})


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    counts: Counter = Counter()
    for batch in batches:
        for _, texts in portions(batch.column(0).to_pylist()):
            for t in texts:
                counts.update(t.split(" "))
            if len(counts) > 8 * SUMMARY:
                counts = _trim(counts, 4 * SUMMARY)
    counts = Counter({k: v for k, v in counts.items() if 0 < len(k) <= KEEP_LENGTH})
    if counts:
        yield _emit(_trim(counts, SUMMARY), TaskContext.get().partitionId())


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    counts: Counter = Counter()
    for batch in batches:
        for row in batch.to_pylist():
            for unit, n in zip(row["units"].split(" "), array("q", row["counts"]), strict=True):
                counts[unit] += n
            counts = _trim(counts, FREQUENT)
    if counts:
        yield _emit(counts, TaskContext.get().partitionId())


def frequent_units(docs: DataFrame, text_col: str = "text") -> list[str]:
    """At most FREQUENT units, frequent ones among them for certain."""
    schema = "task int, units string, counts binary"
    found = docs.select(F.col(text_col)).mapInArrow(_summaries, schema)
    found = found.repartition(GROUPS, F.pmod("task", F.lit(GROUPS))).mapInArrow(_merged, schema)
    rows = found.repartition(1).mapInArrow(_merged, schema).collect()  # one row of at most FREQUENT units
    return [u for r in rows for u in r["units"].split(" ")]


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    small_batches(spark)
    units = frequent_units(docs, text_col)
    lengths = LengthCounter(model_path).lengths(units)
    table = spark.sparkContext.broadcast((" ".join(units), array("I", lengths).tobytes()))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sizes = table.value
        counter = LengthCounter(model_path, dict(zip(words.split(" ") if sizes else [], array("I", sizes), strict=True)))
        for batch in batches:
            text = batch.column(1)
            numbers: list[int] = []
            for _, texts in portions(text.to_pylist()):
                numbers += counter.count(texts)
            n = pa.array(numbers, pa.int64())
            size = pc.fill_null(pc.cast(pc.binary_length(text), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n, pc.greater(n, limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
