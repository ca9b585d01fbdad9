"""Stages of a run as a state machine over their events, resumable: as a batch, and as a stream with typed state.

An event says that a stage started or finished: stage, kind (started or finished), at, ok, errors, inputs_processed,
metadata. A start begins anew (in progress, no inputs, no errors, its own metadata); what finishes later than the last
start sets status, errors and the time, sets inputs_processed if it tells them, and merges its metadata. So the state
depends on the events since the last start, in the order of their times, whatever the order in which they come.

Defined cases: a line that is no event, or lacks stage, kind or time, counts as none; a finish without a start gives a
state without started_at; of events of one time a start comes first and then the greater one last; a stage is done if
its status is ok. Sinks are keyed by batch: a batch that runs again after a crash replaces its own rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

EVENT = "stage string, kind string, at timestamp, ok boolean, errors int, inputs_processed long, metadata map<string,string>"
STATE = "stage string, started_at timestamp, finished_at timestamp, status string, inputs_processed long, errors int, metadata string, is_done boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HELD = "kind string, at timestamp, ok boolean, errors int, inputs_processed long, metadata string"


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Events of JSON texts; what is no event has no row."""
    e = F.from_json(column, EVENT)
    return lines.select(e.alias("e")).select("e.*").where(F.col("stage").isNotNull() & F.col("kind").isin("started", "finished") & F.col("at").isNotNull())


def arriving(spark: SparkSession, folder: str, most: int | None = None) -> DataFrame:
    """Events of the text files of a folder as a stream, at most `most` files a batch."""
    reader = spark.readStream.format("text")
    return parsed((reader if most is None else reader.option("maxFilesPerTrigger", most)).load(folder))


def states(events: DataFrame) -> DataFrame:
    """STATE of every stage of a table of events: partial aggregates, no list of events."""
    began = events.where("kind = 'started'").groupBy("stage").agg(F.max("at").alias("started_at"))
    late = events.join(began, "stage", "left").where((F.col("started_at").isNull()) | (F.col("at") >= F.col("started_at")))
    done = F.col("kind") == "finished"
    order = F.struct("at", F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("inputs_processed", F.lit(-1)).alias("inputs"))
    last = lambda value, which: F.max_by(value, F.when(which, order))
    out = late.groupBy("stage", "started_at").agg(
        F.max(F.when(done, F.col("at"))).alias("finished_at"),
        last(F.coalesce("ok", F.lit(False)), done).alias("ok"),
        last(F.coalesce("errors", F.lit(0)), done).alias("errors"),
        last(F.col("inputs_processed"), done & F.col("inputs_processed").isNotNull()).alias("inputs"),
    )
    status = F.when(F.col("finished_at").isNull(), "in_progress").when(F.col("ok"), "ok").otherwise("failed")
    pairs = late.select("stage", "at", "kind", F.explode("metadata").alias("k", "v")).groupBy("stage", "k").agg(F.max_by("v", F.struct("at", F.col("kind") == "finished", "v")).alias("v"))
    merged = pairs.groupBy("stage").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v"))))).alias("metadata"))
    out = out.join(merged, "stage", "left")
    return out.select("stage", "started_at", "finished_at", status.alias("status"), F.coalesce("inputs", F.lit(0)).alias("inputs_processed"), F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("metadata", F.lit("{}")).alias("metadata"), (status == "ok").alias("is_done"))


def _since_start(events: Iterable[tuple]) -> list[tuple]:
    """The last start, if there is one, and what is not before it; in order."""
    rows = sorted(set(events), key=lambda e: (e[1], e[0] == "finished", e[2] or False, e[3] or 0, -1 if e[4] is None else e[4], e[5]))
    start = max((e[1] for e in rows if e[0] == "started"), default=None)
    return rows if start is None else [e for e in rows if e[1] >= start]


def folded(events: list[tuple]) -> tuple:
    """STATE, but for the stage, of events (kind, at, ok, errors, inputs_processed, metadata) since the last start, in order."""
    started, finished, status, inputs, errors, metadata = None, None, "in_progress", 0, 0, {}
    for kind, at, ok, wrong, n, told in events:
        if kind == "started":
            started = at
        else:
            finished, status, errors = at, "ok" if ok else "failed", wrong or 0
            inputs = inputs if n is None else n
        metadata |= json.loads(told)
    return started, finished, status, inputs, errors, json.dumps(dict(sorted(metadata.items())), ensure_ascii=False, separators=(",", ":")), status == "ok"


class _Stage(StatefulProcessor):
    """Keeps the events of a stage since its last start: as a rule a start and a finish."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", _HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        none = lambda x: None if pd.isna(x) else x
        whole = lambda x: None if pd.isna(x) else int(x)
        new = []
        for batch in rows:
            columns = [batch[c] for c in ("kind", "at", "ok", "errors", "inputs_processed", "metadata")]
            new += [(kind, pd.Timestamp(at).to_pydatetime(), none(ok), whole(errors), whole(n), told) for kind, at, ok, errors, n, told in zip(*columns, strict=True)]
        old = [(k, pd.Timestamp(t).to_pydatetime(), none(ok), whole(e), whole(n), told) for k, t, ok, e, n, told in self.held.get()]
        events = _since_start(old + new)
        self.held.put(events)
        yield pd.DataFrame([(key[0], *folded(events))], columns=[c.split()[0] for c in STATE.split(", ")]).astype({"inputs_processed": "int64", "errors": "int32"})

    def close(self) -> None:
        pass


def state_stream(events: DataFrame) -> DataFrame:
    """STATE of the stages that a batch of a stream of events touches (update mode). The session's state store must be RocksDB
    (use_typed_state)."""
    flat = events.withColumn("metadata", F.coalesce(F.to_json("metadata"), F.lit("{}")))
    return flat.groupBy("stage").transformWithStateInPandas(_Stage(), STATE, "Update", "None")


def use_typed_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def batch_table(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch is a folder of its own, replaced whole if the batch runs again."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def current(spark: SparkSession, path: str) -> DataFrame:
    """The latest STATE of every stage in a batch_table; of many batches, the rows of a stage are compared on the map side."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    fields = [c.split()[0] for c in STATE.split(", ")]
    return rows.groupBy("stage").agg(F.max_by(F.struct(*fields[1:]), "batch").alias("s")).select("stage", "s.*")


def compacted(spark: SparkSession, path: str, into: str) -> None:
    """The current states as one batch (number 0) of another table; the old one is left to the caller."""
    current(spark, path).write.mode("overwrite").parquet(f"{into}/batch=0")


def open_work(inputs: DataFrame, states: DataFrame, key: str = "stage") -> DataFrame:
    """Inputs whose stage is not done, each once: what a resumed run still has to do."""
    return inputs.dropDuplicates([key]).join(states.where("is_done").select(F.col("stage").alias(key)), key, "left_anti")
