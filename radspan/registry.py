"""All registered queries with their SQL, module by module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from radspan.plans import cohort_queries, export_queries, privacy_queries, source_queries, stream_queries, summary_queries, text_queries, volume_queries

MODULES = [cohort_queries, text_queries, privacy_queries, volume_queries, stream_queries, export_queries, summary_queries, source_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
