"""Live ticks kept by a stateful stream; identifiers of file lines; compaction that leaves nothing behind."""

import hashlib
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sieveline.session import scratch_dir
from sieveline.sources import tables
from sieveline.streaming import ticks as T
from test_stream import NOW, event, texts


def put(path, name, values):
    Path(path).mkdir(parents=True, exist_ok=True)
    Path(path, name).write_text("".join(v + "\n" for v in values))


@pytest.fixture
def small_blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield cut
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def ids_of_run(spark, where):
    root, checkpoint = scratch_dir(spark, "out"), scratch_dir(spark, "checkpoint")
    stream = T.read_files(spark, where)
    T.start_gate(stream, root, checkpoint, as_of=F.lit(NOW), received_at=F.lit(NOW), once=True).awaitTermination()
    found = T.stored(spark, root, T.process(stream, F.lit(NOW), F.lit(NOW)))
    return sorted((r.topic, r.offset, r.event_id) for r in found.collect())


def test_lines_keep_their_identifiers_however_files_are_cut(spark, small_blocks):
    where = scratch_dir(spark, "lines")
    same = event(1, event_id="absent")
    put(where, "a.json", [same] * 40 + [event(7)] + [event(2, event_id="absent", volume=-1)] * 3)
    put(where, "b.json", [same, "no json", same])
    runs = []
    for size in (100_000, 700, 251):
        small_blocks(size)
        runs.append(ids_of_run(spark, where))
    assert runs[0] == runs[1] == runs[2]
    assert len({i for *_, i in runs[0]}) == 47
    for topic, offset, found in runs[0]:
        value = Path(topic.removeprefix("file:")).read_text().split("\n")[offset]
        want = "e7" if '"e7"' in value else hashlib.sha256(f"{topic}|0|{offset}|{value}".encode()).hexdigest()
        assert found == want


def minutes(n):
    return (NOW + timedelta(minutes=n)).isoformat()


def test_live_stream_equals_the_batch_and_its_state_is_bounded(spark, rows):
    where, root, checkpoint = (scratch_dir(spark, n) for n in ("in", "live", "checkpoint"))

    def tick(i, at, received, **more):
        return event(i, timestamp=minutes(at), polled_at=minutes(received), **more)

    files = [
        [tick(1, -5, 0, close=101.0), tick(1, -5, 1, close=102.0), tick(2, -5, 0), tick(3, -5, 0, volume=-1)],
        [tick(1, -5, 2, close=103.0), tick(4, 3, 4)],
        [tick(1, -5, 1, close=99.0), tick(2, -5, 0)],  # a late copy, and one delivered again
        [tick(10 + k, 150 + k % 3, 155) for k in range(30)],
        [tick(90, 300, 301), tick(90, 300, 301)],
        [tick(91, 600, 601)],
    ]
    Path(where).mkdir(parents=True)
    stream = T.read_files(spark, where, files_per_trigger=1)
    receipt, checked = F.try_to_timestamp("polled_at"), F.try_to_timestamp("polled_at")
    sizes = []
    for n, values in enumerate(files):
        put(where, f"{n}.json", values)
        query = T.start_live(stream, root, checkpoint, as_of=checked, received_at=receipt, once=True)
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress and query.lastProgress["stateOperators"] else None)
    whole = T.process(texts(rows, [v for f in files for v in f]), checked, receipt)
    columns = T.live_rows(whole).columns
    got = T.live_table(spark, root)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, T.live_ticks(whole).select(*columns).collect()))
    assert {r.event_id: r.close for r in got.collect()}["e1"] == 103.0 and got.count() == 35
    assert sizes[-1] < 10, sizes  # the thirty events of the fourth file have left the state
    assert not list(Path(root).glob("batch_id=*"))
    assert sorted(p.name for p in Path(root).glob("day=*"))


def test_merging_touches_its_days_and_can_be_repeated(spark, rows):
    path, schema = scratch_dir(spark, "merged"), "k string, v int, w int, day date"
    from datetime import date

    one, two = date(2024, 1, 1), date(2024, 1, 2)
    tables.merge_by_day(rows([("a", 1, 1, one), ("b", 1, 1, two)], schema), path, ["k"], ["w"])
    before = {p.name for p in Path(path, "day=2024-01-01").glob("*.parquet")}
    changes = rows([("b", 3, 3, two), ("b", 2, 2, two), ("c", 1, 0, two)], schema)
    for _ in range(2):
        tables.merge_by_day(changes, path, ["k"], ["w"])
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [("a", 1), ("b", 3), ("c", 1)]
    assert {p.name for p in Path(path, "day=2024-01-01").glob("*.parquet")} == before
    tables.merge_by_day(rows([], schema), path, ["k"], ["w"])
    assert spark.read.parquet(path).count() == 3


def test_compaction_removes_what_it_folded(spark, rows):
    root, like = scratch_dir(spark, "ticks"), T.process(texts(rows, []), NOW)
    for n in range(4):
        T.process(texts(rows, [event(1, close=100.0 + n), event(10 + n)]), NOW).write.partitionBy("gate_passed").parquet(f"{root}/batch_id={n}")
    whole = sorted(map(str, T.live_ticks(T.stored(spark, root, like)).collect()))
    first, second = scratch_dir(spark, "first"), scratch_dir(spark, "second")
    T.compact(spark, root, like, first, upto=1, remove_old=True)
    T.compact(spark, root, like, second, upto=2, earlier=first, remove_old=True)
    assert [p.name for p in Path(root).glob("batch_id=*")] == ["batch_id=3"] and not Path(first).exists()
    assert sorted(map(str, T.live_ticks(T.stored_since(spark, root, like, second, 2)).collect())) == whole
