"""A training corpus from raw documents, in five stages that each call one operator of radspan.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the docs of
the next one. All stages but the last return the columns of docs.

Defined cases, for every stage: an empty table gives an empty table; a null text is an empty one; a null id or source is
an id or source of its own kind; decisions are made row by row, so rows that repeat an id are judged each, and of rows
that are equal in text one stays; further columns, whatever their names, pass through unread until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from radspan.llm import exact_dedup, mixing, near_dedup, packing, quality
from radspan.llm.common import work_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Without labels of both kinds all stay; empty texts get a score like any other."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space apart) one row stays: the longest, then the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the row with the smallest id stays; texts without words stay."""
    return near_dedup.keep_first(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated until no source repeats more than MAX_REPEAT times as often as the largest; no document is lost."""
    return mixing.repeat_rows(docs, max_repeat=mixing.MAX_REPEAT)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset; an empty text is a piece of its end id."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: SQL can express neither the classifier nor the packing; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = work_table(docs, f"stage-{i}")
    return docs
