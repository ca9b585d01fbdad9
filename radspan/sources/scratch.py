"""Work tables: written to the cluster's shared folder and read again, so that lineage ends there and lost executors do no harm."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_dirs: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A fresh place below spark.checkpoint.dir; only where that is unset below a folder of our own (local mode: a temporary one)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        local = spark.sparkContext.master.split("[")[0] == "local"
        own = "file://" + tempfile.mkdtemp(prefix="spark-radspan-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_radspan_work"
        root = _dirs.setdefault(spark.sparkContext.applicationId, own)
    return f"{root.rstrip('/')}/radspan-{uuid.uuid4().hex}/{name}"


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt by these columns to as many tasks as a shuffle or the cluster has. For rows that stand for much work, such as a file to
    open or an array to take apart: their own bytes are few, so by these one task would get them all."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


def work_table(df: DataFrame, name: str) -> DataFrame:
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
