"""The tick gate as a stream: parity with batch, replays, restarts."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sieveline import config as C
from sieveline.session import scratch_dir
from sieveline.streaming import ticks as T

NOW = datetime(2024, 1, 1, 12, 0, tzinfo=timezone.utc)


def event(i, **changes):
    at = NOW - timedelta(minutes=5)
    base = dict(
        event_id=f"e{i}", poll_id="p", ticker="A", timestamp=at.isoformat(), polled_at=NOW.isoformat(), open=100.0,
        high=130.0, low=80.0, close=101.0, volume=5, source="s",
    )
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v != "absent"})


def texts(rows, values):
    data = [(None, v, "raw", 0, i) for i, v in enumerate(values)]
    return rows(data, "key string, value string, topic string, partition int, offset bigint")


@pytest.mark.parametrize(
    "changes, code",
    [
        ({}, None),
        ({"volume": "absent"}, C.SCHEMA_MISSING_FIELD),
        ({"close": None}, C.SCHEMA_MISSING_FIELD),
        ({"close": "many"}, C.SCHEMA_WRONG_TYPE),
        ({"close": "101.5"}, None),
        ({"low": 0}, C.RANGE_VIOLATION),
        ({"volume": -1}, C.RANGE_VIOLATION),
        ({"close": 120.0}, None),  # exactly 20 %
        ({"close": 120.1}, C.RANGE_VIOLATION),
        ({"close": 80.0}, None),
        ({"timestamp": (NOW - timedelta(minutes=20)).isoformat()}, None),
        ({"timestamp": (NOW - timedelta(minutes=20, seconds=1)).isoformat()}, C.STALE),
        ({"timestamp": (NOW + timedelta(minutes=2)).isoformat()}, None),
        ({"timestamp": (NOW + timedelta(minutes=2, seconds=1)).isoformat()}, C.STALE),
        ({"timestamp": "2024-01-01T17:25:00+05:30"}, None),
        ({"timestamp": "soon"}, C.STALE),
    ],
)
def test_tick_rules(rows, changes, code):
    row = T.process(texts(rows, [event(1, **changes)]), NOW).first()
    assert row.failure_code == code and row.gate_passed == (code is None)


def test_malformed_message_is_a_failure_not_a_crash(rows):
    got = T.process(texts(rows, ['{"ticker": "A", ', "[]", "null", event(1)]), NOW).collect()
    assert [r.failure_code for r in got[:3]] == [C.SCHEMA_MISSING_FIELD] * 3 and got[3].gate_passed
    assert len({r.event_id for r in got}) == 4 and got[0].ticker == "unknown"
    held = T.quarantine_rows(T.process(texts(rows, ['{"ticker": "A", ']), NOW)).first()
    assert held.raw_event == '{"ticker": "A", '


def test_key_names_the_symbol(rows):
    keyed = texts(rows, [event(1)]).withColumn("key", F.lit("K"))
    assert T.process(keyed, NOW).first().ticker == "K"


def write(path, name, values):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as out:
        out.write("\n".join(values) + "\n")


def run(spark, source, root, checkpoint):
    stream = T.read_files(spark, source)
    query = T.start_gate(stream, root, checkpoint, as_of=NOW, once=True)
    query.awaitTermination()
    return query, T.stored(spark, root, T.process(stream, NOW))


def test_stream_equals_batch_and_restarts(spark, rows, tmp_path):
    source, root, checkpoint = str(tmp_path / "in"), scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    first = [event(1), event(2, close=-1.0), "{broken"]
    write(source, "a.txt", first)
    query, stored = run(spark, source, root, checkpoint)
    assert stored.count() == 3
    metrics = [p.observedMetrics["gate_counts"] for p in query.recentProgress if "gate_counts" in p.observedMetrics]
    assert sum(m.passed for m in metrics) == 1 and sum(m.total for m in metrics) == 3
    # A second run reads only what is new.
    write(source, "b.txt", [event(3), event(1)])
    _, stored = run(spark, source, root, checkpoint)
    assert stored.count() == 5
    batch = T.process(texts(rows, [*first, event(3), event(1)]), NOW)
    key = lambda df: sorted((r.value, r.failure_code or "") for r in df.collect())
    assert key(stored) == key(batch)
    live = {r.event_id: r for r in T.live_ticks(stored).collect()}
    assert sorted(live) == ["e1", "e3"] and live["e1"].volume == 5
    assert live["e1"].bar_timestamp == datetime(2024, 1, 1, 11, 55)
    assert sorted(r.failure_code for r in T.stream_quarantine(stored).collect()) == [C.RANGE_VIOLATION, C.SCHEMA_MISSING_FIELD]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    """Same output folder, new checkpoint: batch 0 runs again, as after a lost commit."""
    source, root = str(tmp_path / "in"), scratch_dir(spark, "out")
    write(source, "a.txt", [event(i) for i in range(4)])
    run(spark, source, root, scratch_dir(spark, "cp"))
    _, stored = run(spark, source, root, scratch_dir(spark, "cp"))
    assert stored.count() == 4


def test_routed_messages(rows):
    out = T.messages(T.process(texts(rows, [event(1), event(2, volume=-1)]), NOW)).orderBy("value").collect()
    bodies = [json.loads(r.value) for r in out]
    assert [r.key for r in out] == ["A", "A"]
    assert bodies[0]["gate_passed"] is True and "failure_code" not in bodies[0]
    assert bodies[1]["failure_code"] == C.RANGE_VIOLATION and bodies[1]["received_at"].startswith("2024-01-01T12:00:00")


def test_first_copy_per_event_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    write(source, "a.txt", [event(i % 5) for i in range(50)])
    stream = T.first_per_event(T.process(T.read_files(spark, source), NOW))
    target = scratch_dir(spark, "first")
    query = (
        stream.select("event_id").writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", scratch_dir(spark, "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.schema("event_id string").parquet(target).count() == 5
