"""Windows over events (an extension), and the state of stages; the same functions take static and streaming tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _late(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    return df.withWatermark(time, delay) if df.isStreaming and delay else df


def tumbling(df: DataFrame, time: str, size: str, by: list[str], value: str, delay: str | None = "1 hour") -> DataFrame:
    out = _late(df, time, delay).groupBy(F.window(time, size), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), *by, "n", "total")


def sliding(df: DataFrame, time: str, size: str, step: str, by: list[str], value: str, delay: str | None = "1 hour") -> DataFrame:
    out = _late(df, time, delay).groupBy(F.window(time, size, step), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), *by, "n", "total")


def sessions(df: DataFrame, time: str, gap: str, by: list[str], delay: str | None = "1 hour") -> DataFrame:
    """start, end (last event plus the gap), n of the runs of events with less than the gap between neighbours."""
    out = _late(df, time, delay).groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def stage_state(events: DataFrame, key: str, status: str, time: str, meta: str | None = None) -> DataFrame:
    """Per stage: first start, latest status (of ties the greatest), whether it is done, events; batch form."""
    last = F.max_by(F.col(status), F.struct(time, status))
    out = events.groupBy(key).agg(F.min(time).alias("started_at"), last.alias("status"), F.count("*").alias("n_events"), *([F.max_by(F.col(meta), F.struct(time, status)).alias("meta")] if meta else []))
    return out.withColumn("is_done", F.col("status") == "ok")


def stage_state_stream(events: DataFrame, key: str, status: str, time: str) -> DataFrame:
    """The same as a stream of updates, with state per stage: key, started_at, status, n_events, is_done."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, last, name, n = state.get if state.exists else (None, None, None, 0)
        for b in batches:
            for t, s in zip(b[time], b[status], strict=True):
                start = t if start is None or t < start else start
                if last is None or (t, s) >= (last, name):
                    last, name = t, s
                n += 1
        state.update((start, last, name, n))
        yield pd.DataFrame({key: [k[0]], "started_at": [start], "status": [name], "n_events": [n], "is_done": [name == "ok"]})

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, status, time).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, started_at timestamp, status string, n_events long, is_done boolean", "started_at timestamp, last timestamp, status string, n long", "update", GroupStateTimeout.NoTimeout)


def run_report(events: DataFrame, status: str, error: str, most: int = 20) -> DataFrame:
    """One row: events, failures, and at most `most` errors in order."""
    first = events.where((F.col(status) == "failed") & F.col(error).isNotNull()).select(F.col(error).alias("e")).distinct().orderBy("e").limit(most)
    errors = first.agg(F.array_sort(F.collect_list("e")).alias("errors"))  # one row of at most `most` texts
    return events.agg(F.count("*").alias("n"), F.count_if(F.col(status) == "failed").alias("n_failed")).join(F.broadcast(errors))
