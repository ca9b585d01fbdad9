"""The stage machine as a batch and as a stream, killed between two batches and started again."""

import json
import random
from datetime import datetime, timedelta

import pytest

from radspan.streaming import stages

T0 = datetime(2024, 5, 1, 12)


def _line(stage, kind, minute, **more):
    return json.dumps({"stage": stage, "kind": kind, "at": (T0 + timedelta(minutes=minute)).isoformat(), **more})


def _states(spark, lines):
    return {r.stage: r for r in stages.states(stages.parsed(spark.createDataFrame([(x,) for x in lines], "value string"))).collect()}


def test_starts_finishes_and_merged_metadata(spark):
    got = _states(
        spark,
        [
            _line("quality", "started", 0, metadata={"pending": "9"}), _line("quality", "finished", 5, ok=True, inputs_processed=42, metadata={"out": "/x"}),
            _line("upload", "started", 0), _line("upload", "finished", 1, ok=False, errors=3),
            _line("running", "started", 2), _line("orphan", "finished", 3, ok=True),
            _line("again", "started", 0, metadata={"a": "1"}), _line("again", "finished", 1, ok=True, inputs_processed=5), _line("again", "started", 2),
            "{broken", "", "[1]", '{"stage": "no time", "kind": "started"}', _line("odd", "paused", 0),
        ],
    )
    r = got["quality"]
    assert (r.status, r.errors, r.inputs_processed, r.is_done, r.started_at, r.finished_at) == ("ok", 0, 42, True, T0, T0 + timedelta(minutes=5))
    assert json.loads(r.metadata) == {"pending": "9", "out": "/x"}
    assert (got["upload"].status, got["upload"].errors, got["upload"].is_done, got["upload"].started_at) == ("failed", 3, False, T0)
    assert (got["running"].status, got["running"].finished_at) == ("in_progress", None)
    assert (got["orphan"].status, got["orphan"].started_at) == ("ok", None)
    r = got["again"]
    assert (r.status, r.inputs_processed, r.metadata, r.finished_at) == ("in_progress", 0, "{}", None)
    assert set(got) == {"quality", "upload", "running", "orphan", "again"}


def test_no_events(spark):
    assert _states(spark, []) == {}


def _random_lines(rng, n):
    out = []
    for _ in range(n):
        kind = rng.choice(("started", "finished"))
        more = {"metadata": {rng.choice("abc"): str(rng.randint(0, 9))}} if rng.random() < 0.5 else {}
        if kind == "finished":
            more |= {"ok": rng.random() < 0.6, "errors": rng.randint(0, 3)} | ({"inputs_processed": rng.randint(0, 99)} if rng.random() < 0.5 else {})
        out.append(_line(f"s{rng.randint(0, 6)}", kind, rng.randint(0, 100_000) / 7, **more))
    return [*out, "{broken"]


@pytest.fixture
def typed(spark):
    stages.use_typed_state(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def _run(spark, root, table, sink):
    rows = stages.state_stream(stages.arriving(spark, f"{root}/in", 1))
    query = rows.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{root}/{table}-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination(240)
    return query


def test_killed_between_batches_and_started_again(spark, tmp_path, typed):
    """The second batch dies after its rows are written and before it is committed; the table ends as if nothing had happened."""
    rng, lines = random.Random(3), []
    (tmp_path / "in").mkdir()
    for i in range(4):  # files in an order that is not that of the events' times
        part = _random_lines(rng, 12)
        lines += part
        (tmp_path / f"in/{i}.txt").write_text("\n".join(part))
    write, died = stages.batch_table(f"{tmp_path}/killed"), []

    def dies_once(rows, batch):
        write(rows, batch)
        if batch == 1 and not died:
            died.append(batch)
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        _run(spark, tmp_path, "killed", dies_once)
    _run(spark, tmp_path, "killed", dies_once)
    assert died == [1]
    got = {r.stage: tuple(r) for r in stages.current(spark, f"{tmp_path}/killed").collect()}
    assert got == {k: tuple(r) for k, r in _states(spark, lines).items()}
    stages.compacted(spark, f"{tmp_path}/killed", f"{tmp_path}/compact")
    assert {r.stage: tuple(r) for r in stages.current(spark, f"{tmp_path}/compact").collect()} == got
    done = {k for k, r in got.items() if r[-1]}
    work = spark.createDataFrame([(f"s{i}",) for i in range(9)] * 2, "stage string")
    assert sorted(r.stage for r in stages.open_work(work, stages.current(spark, f"{tmp_path}/killed")).collect()) == sorted({f"s{i}" for i in range(9)} - done)
