"""The pipeline against its stages put together by hand, and the driver's entry."""

from collections import Counter

import __spark_entry__
import corpus_pipeline
from radspan.llm import exact_dedup, near_dedup, quality


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources", "best-fit packing"]
    scores = {r.doc_id: r.predicted for r in quality.scored(docs, labels).collect()}
    good = docs.where(docs.doc_id.isin([i for i, p in scores.items() if p]))
    first = good.where(good.doc_id.isin([r.doc_id for r in exact_dedup.decide(good).collect() if r.kept]))
    apart = [r.doc_id for r in near_dedup.link(first).collect() if r.kept]
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(apart)
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048


def test_stages_keep_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, "").columns == docs.columns, name


def test_registered():
    found = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in found} and "pipeline" in found
    assert set(__spark_entry__.oracle_sql()) <= set(found)


def test_empty_table(spark, empty_docs, tmp_path):
    empty_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and {"doc_id", "piece", "sequence_id"} <= set(got.columns)


def test_first_and_last_stage_on_odd_rows(spark, docs, tmp_path):
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    good = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    assert good.columns == docs.columns
    assert Counter(map(tuple, good.collect())) <= Counter(map(tuple, docs.collect()))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.where("piece = 0").count() == docs.count()
