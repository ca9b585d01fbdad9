"""Event windows and stage states over the events table, in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from radspan.plans.proxies import table
from radspan.sources import inventory
from radspan.streaming import stages, windows


def _events(spark, sf):
    return table(spark, sf, "events")


def events_tumbling(spark, sf):
    return windows.tumbling(_events(spark, sf), "ts", "1 day", ["event_type"], "value").withColumn("total", F.round("total", 4))


def events_sliding(spark, sf):
    return windows.sliding(_events(spark, sf), "ts", "2 days", "1 day", ["event_type"], "value").withColumn("total", F.round("total", 4))


def events_session(spark, sf):
    return windows.sessions(_events(spark, sf), "ts", "3 hours", ["user_id"])


def _stages(spark, sf):
    s = F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "error", "failed").otherwise("in_progress")
    return _events(spark, sf).select("user_id", s.alias("status"), "ts", F.concat(F.lit("E"), F.col("user_id") % 5).alias("error"))


def stage_state(spark, sf):
    return windows.stage_state(_stages(spark, sf), "user_id", "status", "ts")


def run_report(spark, sf):
    return windows.run_report(_stages(spark, sf), "status", "error", 3).withColumn("errors", F.array_join("errors", "|"))


def stage_machine(spark, sf):
    """Events as starts and finishes of the stages of their users: the merged state of each stage."""
    i = F.col("event_id")
    kind = F.when(i % 3 == 0, "started").otherwise("finished")
    told = F.create_map(F.concat(F.lit("k"), (i % 3).cast("string")), F.col("event_type"))
    rows = _events(spark, sf).select(F.concat(F.lit("u"), "user_id").alias("stage"), kind.alias("kind"), F.col("ts").alias("at"), (F.col("event_type") == "purchase").alias("ok"), (i % 4).cast("int").alias("errors"), F.when(i % 2 == 0, i % 100).alias("inputs_processed"), told.alias("metadata"))
    return stages.states(rows)


def text_metadata(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *[c.cast("long").alias(n) for n, c in inventory.text_metadata(F.col("text")).items() if n != "n_words"])


QUERIES = {f.__name__: f for f in (events_tumbling, events_sliding, events_session, stage_state, stage_machine, run_report, text_metadata)}
_STATUS = "CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'failed' ELSE 'in_progress' END"
ORACLE = {
    "events_tumbling": "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "events_sliding": "SELECT date_trunc('day', ts) - INTERVAL 1 DAY * k AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, (VALUES (0), (1)) v(k) GROUP BY 1, 2",
    "events_session": "WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS b FROM events), c AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a) SELECT min(ts) AS start, max(ts) + INTERVAL 3 HOUR AS end, user_id, count(*) AS n FROM c GROUP BY user_id, s",
    "stage_state": f"WITH a AS (SELECT user_id, ts, {_STATUS} AS status FROM events) SELECT user_id, min(ts) AS started_at, arg_max(status, (ts, status)) AS status, count(*) AS n_events, arg_max(status, (ts, status)) = 'ok' AS is_done FROM a GROUP BY user_id",
    "run_report": "SELECT count(*) AS n, count_if(event_type = 'error')::BIGINT AS n_failed, array_to_string(list_sort(list_distinct(list('E' || (user_id % 5)) FILTER (event_type = 'error')))[1:3], '|') AS errors FROM events",
    "text_metadata": "SELECT doc_id, length(text)::BIGINT AS n_chars, (length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS n_lines FROM documents",
}
ORACLE["stage_machine"] = """WITH e AS (
  SELECT 'u' || user_id AS stage, ts, event_id % 3 = 0 AS start, event_type = 'purchase' AS ok, CAST(event_id % 4 AS INT) AS errors, CASE WHEN event_id % 2 = 0 THEN event_id % 100 END AS inputs, 'k' || event_id % 3 AS k, event_type AS v FROM events
), b AS (SELECT *, max(ts) FILTER (start) OVER (PARTITION BY stage) AS began FROM e), l AS (SELECT * FROM b WHERE began IS NULL OR ts >= began),
m AS (SELECT stage, k, arg_max(v, (ts, NOT start, v)) AS v FROM l GROUP BY 1, 2), j AS (SELECT stage, '{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}' AS metadata FROM m GROUP BY 1),
f AS (
  SELECT stage, any_value(began) AS started_at, max(ts) FILTER (NOT start) AS finished_at, arg_max(ok, (ts, ok, errors, coalesce(inputs, -1))) FILTER (NOT start) AS ok, arg_max(errors, (ts, ok, errors, coalesce(inputs, -1))) FILTER (NOT start) AS errors,
    arg_max(inputs, (ts, ok, errors, inputs)) FILTER (NOT start AND inputs IS NOT NULL) AS inputs FROM l GROUP BY 1
)
SELECT f.stage, started_at, finished_at, CASE WHEN finished_at IS NULL THEN 'in_progress' WHEN ok THEN 'ok' ELSE 'failed' END AS status, CAST(coalesce(inputs, 0) AS BIGINT) AS inputs_processed, coalesce(errors, 0)::INT AS errors, metadata, finished_at IS NOT NULL AND ok AS is_done FROM f JOIN j ON f.stage = j.stage"""
