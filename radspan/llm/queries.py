"""The thin queries opN_<name>: each operator over its whole table with production parameters, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.llm import exact_dedup, filter_audit, language_id, mixing, near_dedup, packing, quality, shard, simhash, spelling, token_counts, token_files, topk


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _tokenizer(name: str) -> str:
    """The place of a public vocabulary file; any other place can be given to the operators themselves."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.fresh_path(spark)
    token_files.write(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), path)
    return token_files.read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir), max_repeat=mixing.MAX_REPEAT)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.search(vectors, vectors.where(F.col("vec_id") % topk.EVERY == 0), topk.K)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(_documents(spark, sf_dir), words=3, percent=85)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard(_documents(spark, sf_dir), 8)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link(_documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(_documents(spark, sf_dir), damage=199)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_token_files, op3_mixing, op4_token_counts, op5_topk, op6_exact_dedup, op7_language_id, op8_quality, op9_near_dedup, op10_sharding, op11_filter_audit, op12_simhash, op13_spelling)}


OP6_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha FROM documents
), w AS (
  SELECT *, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size, row_number() OVER g = 1 AS kept FROM d
  WINDOW g AS (PARTITION BY sha ORDER BY n DESC, doc_id NULLS FIRST)
)
SELECT doc_id, keep_id, group_size, kept, sha AS text_sha256 FROM w
"""


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
), q AS (SELECT vec_id AS query_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM v WHERE vec_id % 100 = 0),
c AS (SELECT vec_id, unnest(e) AS y, unnest(range(len(e))) AS i FROM v),
s AS (SELECT query_id, vec_id, CAST(sum(x * y) AS BIGINT) AS score FROM q JOIN c ON q.i = c.i AND query_id <> vec_id GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_topk": OP5_SQL, "op3_mixing": mixing.ORACLE_SQL, "op6_exact_dedup": OP6_SQL, "op11_filter_audit": filter_audit.ORACLE_SQL}
