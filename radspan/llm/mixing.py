"""Temperature mixing of sources, realised as budgeted block permutations.

Source s holds n_s tokens, a share p_s of all. Its weight is p_s ** a, normalised. The exponent a lies on the grid
0, 1/1024, ..., 1 and is bisected: with a target entropy it is the largest a whose weights still have that entropy,
with a repetition limit the smallest a at which no source repeats more often than the limit. Unless a token budget is
given, the budget is such that the source repeated least is taken exactly once, so no document is left out.

A source is cut into blocks of about BLOCK_TOKENS tokens by a hash of the id. Each block has a budget, its tokens
times the repetition of its source, and is passed in a new permutation again and again until the budget is spent; of
the last pass, the documents that end within the budget are taken. Windows see one block, whatever the source's size.
DataFrame functions only.

Defined cases: a document costs its words plus one (its end), so an empty or null text costs 1; a null source is a
source of its own; ties in a permutation go by id, then by row; rows that repeat an id are rows of their own; rows
without an id are dealt by their number; a target entropy below that of the natural shares gives these (exponent 1), one
above the logarithm of the number of sources gives equal weights (exponent 0); an empty table gives an empty result;
other columns are never read by mix(), and kept as they are by repeat_rows().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.llm.common import WORD, clean_text, hash_order, numbered, sized, work_table

GRID = 1024
BLOCK_TOKENS = 1 << 16
#: Production parameters of the query and of the pipeline's stage.
MAX_REPEAT = 2.0
SEED = "mix-1"


def source_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("tokens").alias("n"), F.count("*").alias("docs"))


def _measures(totals: DataFrame, exponent: float) -> tuple[float, float]:
    """Entropy of the weights at this exponent, and the repetition of the smallest source against the largest."""
    power = F.pow(F.col("n").cast("double"), F.lit(exponent))
    row = totals.agg(F.sum(power).alias("z"), F.sum(power * F.ln(power)).alias("u"), F.max("n").alias("top"), F.min("n").alias("least")).first()
    return math.log(row.z) - row.u / row.z, (row.top / row.least) ** (1 - exponent)


def bisect_exponent(totals: DataFrame, target_entropy: float | None = None, max_repeat: float | None = None) -> float:
    """The exponent that meets exactly one of the two targets; totals: source, n > 0."""
    if (target_entropy is None) == (max_repeat is None):
        raise ValueError("give a target entropy or a repetition limit")
    low, high = 0, GRID
    while low < high:
        if max_repeat is not None:  # repetition falls with the exponent: the smallest that is low enough
            mid = (low + high) // 2
            fits = _measures(totals, mid / GRID)[1] <= max_repeat
            low, high = (low, mid) if fits else (mid + 1, high)
        else:  # entropy falls with the exponent: the largest at which it is high enough, or 0
            mid = (low + high + 1) // 2
            fits = _measures(totals, mid / GRID)[0] >= target_entropy
            low, high = (mid, high) if fits else (low, mid - 1)
    return low / GRID


def _placed(docs: DataFrame, row: Column, target_entropy: float | None, max_repeat: float | None, budget_tokens: int | None, seed: str, block_tokens: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per placed row of docs: row, id, source, block, pass, position, tokens."""
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), (F.regexp_count(clean_text(F.col(text_col)), F.lit(WORD)) + 1).cast("long").alias("tokens"))
    rows = work_table(rows, "tokens")
    totals = work_table(source_totals(rows), "totals")
    sources, top, corpus = totals.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    exponent = bisect_exponent(totals, target_entropy, max_repeat) if sources else 1.0
    # repetition of a source: its weight over its share, in units of the source that repeats least
    repeat = F.pow(F.lit(float(top or 1)) / F.col("n"), F.lit(1 - exponent))
    if budget_tokens is not None and sources:
        spent = totals.agg(F.sum(F.col("n") * repeat)).first()[0]
        repeat = repeat * F.lit(budget_tokens / spent)
    totals = totals.select(F.col("source").alias("of"), repeat.alias("repeat"), F.ceil(F.col("n") / block_tokens).cast("long").alias("blocks"))
    rows = rows.join(sized(totals, sources), F.col("source").eqNullSafe(F.col("of")))
    own = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string")))
    rows = rows.select("row", "id", own.alias("own"), "source", "tokens", "repeat", F.pmod(hash_order(seed, "block", own), F.col("blocks")).cast("int").alias("block"))
    passes = rows.where("repeat > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.ceil("repeat").cast("int") - 1)))
    passes = passes.withColumn("order", hash_order(seed, F.col("pass").cast("string"), F.col("own")))
    block = Window.partitionBy("source", "block", "pass")
    order = block.orderBy("order", "id", "tokens", "row")
    along = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passes = passes.withColumn("whole", F.sum("tokens").over(block)).withColumn("end", F.sum("tokens").over(along)).withColumn("position", F.row_number().over(order) - 1)
    fits = F.col("pass") * F.col("whole") + F.col("end") <= F.floor(F.col("whole") * F.col("repeat"))
    return passes.where(fits).select("row", "id", "source", "block", "pass", F.col("position").cast("int").alias("position"), "tokens")


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeat: float | None = None,
    budget_tokens: int | None = None,
    seed: str = SEED,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per placed document: id, source, block, pass (from 0), position (in its block's pass, from 0), tokens."""
    placed = _placed(docs, F.monotonically_increasing_id(), target_entropy, max_repeat, budget_tokens, seed, block_tokens, id_col, text_col, source_col)
    return placed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "block", "pass", "position", "tokens")


def repeat_rows(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeat: float | None = None,
    budget_tokens: int | None = None,
    seed: str = SEED,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """docs, all columns, each row as often as mix() places it."""
    copy, row = numbered(docs)
    placed = _placed(copy, F.col(row), target_entropy, max_repeat, budget_tokens, seed, block_tokens, id_col, text_col, source_col)
    times = placed.groupBy("row").agg(F.count("*").alias("times"))
    if budget_tokens is None:  # every row is placed once at least: only the others have to be found
        more = work_table(times.where("times > 1").select(F.col("row").alias("_of"), "times"), "more")
        out, often = copy.join(sized(more), copy[row] == more["_of"], "left"), F.coalesce(more["times"], F.lit(1))
    else:
        more = work_table(times.select(F.col("row").alias("_of"), "times"), "more")
        out, often = copy.join(sized(more), copy[row] == more["_of"]), more["times"]
    return out.select(*[copy[f"`{c}`"] for c in docs.columns], F.explode(F.sequence(F.lit(1), often.cast("int"))).alias(row)).drop(row)


#: DuckDB SQL for mix(documents, max_repeat=MAX_REPEAT).
ORACLE_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS BIGINT) AS tokens FROM documents
), totals AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS n FROM rows GROUP BY source),
ends AS (SELECT max(n) AS top, min(n) AS least FROM totals),
found AS (
  SELECT min(g.k) / {GRID}.0::DOUBLE AS a FROM range(0, {GRID + 1}) g(k), ends
  WHERE pow(top / least::DOUBLE, 1 - g.k / {GRID}.0::DOUBLE) <= {MAX_REPEAT}
), mixed AS (
  SELECT source, pow(top / n::DOUBLE, 1 - a) AS repeat, CAST(ceil(n / {BLOCK_TOKENS}.0) AS BIGINT) AS blocks FROM totals, ends, found
), dealt AS (
  SELECT r.doc_id, r.source, r.tokens, m.repeat, CAST(CAST('0x' || substr(md5('{SEED}:block:' || CAST(r.doc_id AS VARCHAR)), 1, 15) AS BIGINT) % m.blocks AS INTEGER) AS block
  FROM rows r JOIN mixed m ON r.source IS NOT DISTINCT FROM m.source
), passes AS (
  SELECT d.*, p.pass, CAST('0x' || substr(md5('{SEED}:' || CAST(p.pass AS VARCHAR) || ':' || CAST(d.doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS ord
  FROM dealt d JOIN (SELECT CAST(unnest(range(0, (SELECT CAST(max(ceil(repeat)) AS BIGINT) FROM mixed))) AS INTEGER) AS pass) p ON p.pass < ceil(d.repeat)
), run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source, block, pass) AS whole,
    sum(tokens) OVER (PARTITION BY source, block, pass ORDER BY ord, doc_id, tokens ROWS UNBOUNDED PRECEDING) AS done,
    row_number() OVER (PARTITION BY source, block, pass ORDER BY ord, doc_id, tokens) - 1 AS position
  FROM passes
)
SELECT doc_id, source, block, pass, CAST(position AS INTEGER) AS position, tokens FROM run
WHERE pass * whole + done <= floor(whole * repeat)
"""
