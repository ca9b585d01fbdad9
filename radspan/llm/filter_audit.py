"""Audit of a chain of document filters in every order, by aggregated edges of the subset lattice.

A document fails some of the filters; that set is its mask. Whether it is still there when filter f comes, and what f
does with it, hangs only on f and on the set of filters applied before, in any order: an edge of the subset lattice. So
documents are added up on the n * 2 ** (n - 1) edges of their part (80 for five filters), and each step of each order
(600) is one edge: the orders are paths that join the edges. Documents are counted by (part, mask, label) on the map
side first, so what meets the edges is at most 2 ** n * 4 rows a part, whatever the number of documents; a part that
holds most rows is no more work than any other.

The five filters of failures(): A too few words, B too few distinct words, C too many capitals, D one of MARKS, E a copy
of a text with a smaller id anywhere in the table.

Defined cases: a null text is empty (and a copy of other empty ones); a null part is the empty string; a row without id
is no copy and no row is a copy of it, and it has no label; rows of one id and text are no copies of each other; an id
with several labels counts as good (toxic) if one of them says so; an empty table has no parts and no rows; other
columns are never read. Texts are read in portions, so a task holds a portion and the distinct words of one text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.llm.common import small_batches, work_table
from radspan.llm.shingles import _pieces

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, MARKS = 200, 50, 2, b"#$%&*|"
_CAPITALS, _FOLLOWING = bytes(range(ord("A"), ord("Z") + 1)), bytes(range(0x80, 0xC0))


def mask_of(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3. bytes.split() cuts at [\\x20\\x09-\\x0D]."""
    words, seen, capitals, points, marked = 0, set(), 0, 0, False
    for piece in _pieces(text):
        found = piece.split()
        words += len(found)
        seen.update(found)
        capitals += len(piece) - len(piece.translate(None, _CAPITALS))
        points += len(piece.translate(None, _FOLLOWING))
        marked = marked or len(piece.translate(None, MARKS)) < len(piece)
    fails = (words < LEAST_WORDS, 100 * len(seen) < LEAST_DISTINCT_PERCENT * words, 100 * capitals > MOST_CAPITALS_PERCENT * points, marked)
    return sum(fail << i for i, fail in enumerate(fails))


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        masks = pa.array([mask_of(t) for t in texts], pa.int32())
        digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, digests], names=["id", "part", "mask", "digest"])


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per row of docs: part, mask (bits in the order of FILTERS), good, toxic.

    A row is no copy if it has the least id of its text; that is looked up by text and id together, so the rows of a
    text that fills a third of the table are spread over all tasks.
    """
    small_batches(docs.sparkSession)
    some = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    kind = some.schema["id"].dataType.simpleString()
    rows = work_table(some.mapInArrow(_measured, f"id {kind}, part string, mask int, digest binary"), "measured")
    named, unnamed = rows.where("id IS NOT NULL"), rows.where("id IS NULL")
    first = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    said = labels.select(F.col(id_col).alias("id"), F.col("quality").eqNullSafe(1).alias("good"), F.col("toxic").eqNullSafe(1).alias("toxic"))
    said = said.where("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    copy = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    named = named.join(first, ["digest", "id"], "left").join(said, "id", "left")
    named = named.select("part", F.col("mask").bitwiseOR(copy).alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    return named.unionByName(unnamed.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def edges(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """rows: part, mask, good, toxic. One row per part, subset (bits applied before) and filter (its place): the counts of the edge."""
    n = len(filters)
    tallies = rows.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    every = F.array(*[F.struct(F.lit(s).alias("subset"), F.lit(f).alias("filter")) for s in range(1 << n) for f in range(n) if not s >> f & 1])
    at = tallies.withColumn("edge", F.explode(every)).select("*", "edge.subset", "edge.filter", F.call_function("shiftleft", F.lit(1), F.col("edge.filter")).alias("bit"))
    here, fails = F.col("mask").bitwiseAND(F.col("subset")) == 0, F.col("mask").bitwiseAND(F.col("bit")) != 0

    def counted(which: Column, name: str) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0)).alias(name)

    return at.groupBy("part", "subset", "filter").agg(
        counted(here & ~fails, "kept"),
        counted(here & fails, "removed"),
        counted(~here & fails, "redundant"),
        counted(F.col("mask") == F.col("bit"), "unique_fails"),
        counted(here & fails & F.col("good"), "good_lost"),
        counted(here & fails & F.col("toxic"), "toxic_lost"),
    )


def steps(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """Each step of each order as an edge: filter_order, step, subset, filter; n! * n rows."""
    rows = []
    for order in permutations(range(len(filters))):
        name, subset = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            rows.append((name, step, subset, f))
            subset |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, subset int, filter int")


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """rows: part, mask, good, toxic. One row per part, order and step.

    Of all orders, |S|! (n - 1 - |S|)! go through the edge (S, f): that weighs the edges of shapley.
    """
    n, found = len(filters), work_table(edges(rows, filters), "edges")
    ways = F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)])
    shapley = found.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.get(ways, F.bit_count("subset"))).alias("shapley"))
    paths = found.join(F.broadcast(steps(rows.sparkSession, filters)), ["subset", "filter"]).join(shapley, ["part", "filter"])
    return paths.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


#: The same by walking every order for every mask, without the lattice.
ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f, left(filter_order, step - 1) AS earlier
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, f, good, toxic, n, fails = f AS only_f, contains(fails, f) AS hit,
    length(earlier) > 0 AND len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AS gone
  FROM c, s
), g AS (
  SELECT part, filter_order, step, f,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (only_f), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (NOT gone AND hit AND good), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n) FILTER (NOT gone AND hit AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM g
"""
