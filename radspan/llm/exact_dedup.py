"""Exact duplicates by digest; frequent digests are resolved on the map side.

A Misra-Gries pass names every digest that may hold a share `support` of the rows. The named digests are counted
exactly (a partial aggregate of at most 1/support groups), the true heavy ones are broadcast with their winners, and
their rows are decided where they lie. All other digests go through an ordinary shuffle, where none is heavy.
DataFrame functions only.

Defined cases: a null text counts as empty; texts are equal when they are identical without white space
[\\x20\\x09-\\x0D]; of equal texts the row with the most code points, then the smallest id stays (a null id is the
smallest); of rows that repeat an id and a text one stays, whichever comes first; an empty table gives an empty
result; other columns are never read by decide(), and kept as they are by keep_first().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import SPACES, clean_text, numbered, sized, with_group, work_table

#: Share of the rows from which a digest is decided on the map side; 1/SUPPORT bounds what is broadcast.
SUPPORT = 0.001


def _digest(text):
    out = clean_text(text)
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return F.sha2(out, 256)


def _decided(docs: DataFrame, row: Column, id_col: str, text_col: str, support: float) -> DataFrame:
    """One row per row of docs: row, id, keep, size, kept, sha."""
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.char_length(clean_text(F.col(text_col))).alias("n"), _digest(F.col(text_col)).alias("sha"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").alias("id"), F.col("row").alias("row")))
    made = with_group(work_table(rows, "digests"), "sha", [best.alias("best"), F.count("*").alias("size")], support)
    return made.select("row", "id", F.col("best.id").alias("keep"), "size", (F.col("row") == F.col("best.row")).alias("kept"), "sha")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256."""
    made = _decided(docs, F.monotonically_increasing_id(), id_col, text_col, support)
    return made.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """docs, all columns, with one row of each group of equal texts."""
    copy, row = numbered(docs)
    gone = work_table(_decided(copy, F.col(row), id_col, text_col, support).where(~F.col("kept")).select(F.col("row").alias(row)), "gone")
    return copy.join(sized(gone), row, "left_anti").drop(row)
