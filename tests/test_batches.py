"""The store by day: touched days only, pruned lookups with the same verdicts, replays, folding, isolated sources."""

import shutil
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sieveline import config as C
from sieveline.plans import runs
from sieveline.session import scratch_dir
from sieveline.sources.batches import BatchStore, GateJob

NEWS = C.RULES["news"]
RAW = "article_id string, title string, url string, published_at string, seq bigint"


def article(name, day, seq=0, title="t"):
    return (name, title, "u", f"2024-03-{day:02d}T10:00:00Z", seq)


def at(day):
    return datetime(2024, 3, day, 12, tzinfo=timezone.utc)


def job(rows, data, day, stable=True, **more):
    return GateJob(NEWS, lambda: rows(list(data), RAW), at(day), table="bronze_news", sequence="seq", stable_time=stable, **more)


def ids(df):
    return sorted(r.article_id for r in df.collect())


def day_files(root):
    return {p.parent.name: p.name for p in Path(root, "verified", "news").glob("day=*/*.parquet")}


@pytest.fixture(scope="module")
def ten_batches(spark):
    """Ten batches, one a day; each brings yesterday's article again."""
    rows, root = spark.createDataFrame, scratch_dir(spark, "history")
    for day in range(1, 11):
        data = [article(f"a{day}", day), article(f"a{day - 1}", max(1, day - 1), 1), article(f"bad{day}", day, title=" ")]
        last = job(rows, data, day)
        runs.run_batch(spark, {"news": last}, root, day)
    return root, last, rows([], RAW).schema


@pytest.fixture
def history(spark, ten_batches):
    root = scratch_dir(spark, "copy")
    shutil.copytree(ten_batches[0], root)
    return root, *ten_batches[1:]


def test_batches_by_day_equal_the_unpruned_store(spark, rows, history):
    root, last, like = history
    store = BatchStore(spark, root)
    assert ids(store.verified(last, like)) == sorted(["a0", *(f"a{d}" for d in range(1, 11))])
    codes = {(r.batch, r.article_id): r.failure_code for r in store.decisions(last, like).collect()}
    assert codes == {(d, f"a{d}"): None for d in range(1, 11)} | {(d, f"a{d - 1}"): C.DUPLICATE if d > 1 else None for d in range(1, 11)} | {(d, f"bad{d}"): C.RANGE_VIOLATION for d in range(1, 11)}
    unpruned = scratch_dir(spark, "unpruned")
    for day in range(1, 11):
        data = [r[:-1] for r in store.decisions(last, like).where(F.col("batch") == day).select(*like.names, "batch").collect()]
        runs.run_batch(spark, {"news": job(rows, data, day, stable=False)}, unpruned, day)
    free = job(rows, [], 10, stable=False)
    other = BatchStore(spark, unpruned)
    assert {(r.batch, r.article_id): r.failure_code for r in other.decisions(free, like).collect()} == codes
    assert ids(other.verified(free, like)) == ids(store.verified(last, like))


def test_a_batch_reads_and_rewrites_its_days_only(spark, rows, history):
    root, last, like = history
    before = day_files(root)
    again = job(rows, [article("late", 9), article("a10", 10, 1), article("a3", 3, 2)], 10)
    store = BatchStore(spark, root)
    known = store.known(again, again.records(), 11)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = plan_of(store.known(again, again.records(), 11))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "2024-03-07" in filters and "2024-03-11" in filters and "2024-03-03" not in filters
    assert ids(known) == ["a10", "a7", "a8", "a9"]  # a window of two days, and one on each side
    runs.run_batch(spark, {"news": again}, root, 11)
    after = day_files(root)
    assert {d for d in after if after[d] != before.get(d)} == {"day=2024-03-09"}
    assert ids(store.verified_days(last, [datetime(2024, 3, 9).date()])) == ["a9", "late"]
    codes = {r.article_id: r.failure_code for r in store.decisions(again, like).where("batch = 11").collect()}
    assert codes == {"late": None, "a10": C.DUPLICATE, "a3": C.STALE}


def test_a_replay_rebuilds_the_days_it_had(spark, rows, history):
    """A corrected batch that no longer has its article frees the day; what another batch wrote stays."""
    root, last, like = history
    store = BatchStore(spark, root)
    runs.run_batch(spark, {"news": job(rows, [article("new", 4, title="x")], 5)}, root, 5)
    assert ids(store.verified(last, like)) == sorted(["a0", "new", *(f"a{d}" for d in range(1, 11) if d != 5)])
    runs.run_batch(spark, {"news": job(rows, [article("new", 4, title="x")], 5)}, root, 5)
    assert store.decisions(last, like).where("batch = 5").count() == 1
    with_check_column = GateJob(NEWS, lambda: rows([article("a4", 4)], RAW).withColumn("now", F.lit(at(5))), F.col("now"), table="bronze_news", sequence="seq", stable_time=True, record_fields=tuple(like.names))
    assert store.reachable_days(with_check_column, with_check_column.records()) == [datetime(2024, 3, 4).date()]


def test_folded_batches_keep_every_decision(spark, rows, history):
    root, last, like = history
    store = BatchStore(spark, root)
    whole = lambda: sorted(map(str, store.decisions(last, like).select("batch", "article_id", "failure_code", "record_id", "day", "passed").collect()))
    before, log = whole(), store.gate_log(last, like).count()
    store.fold(last, like, upto=4)
    store.fold(last, like, upto=8)
    assert whole() == before and store.gate_log(last, like).count() == log
    assert sorted(p.name for p in Path(root, "decisions", "news").glob("batch=*")) == ["batch=10", "batch=9"]
    assert [p.name for p in Path(root, "closed", "news").glob("upto=*")] == ["upto=8"]
    closed = runs.run_batch(spark, {"news": job(rows, [article("x", 3)], 3)}, root, 3).first()
    assert closed.status == "failed" and "closed" in closed.error
    runs.run_batch(spark, {"news": job(rows, [article("a10", 10), article("a11", 11)], 11)}, root, 11)
    assert {r.article_id: r.failure_code for r in store.decisions(last, like).where("batch = 11").collect()} == {"a10": C.DUPLICATE, "a11": None}


def test_sources_run_side_by_side_and_fail_alone(spark, rows):
    root = scratch_dir(spark, "sources")
    broken = GateJob(NEWS, lambda: rows([article("a", 1)], RAW).withColumn("title", F.raise_error(F.lit("while running"))), at(1), table="bronze_news", sequence="seq")
    unsorted = job(rows, [article("a", 1)], 1, intra_batch="seq")
    no_sequence = GateJob(unsorted.rules, unsorted.records, unsorted.as_of, intra_batch="seq", table="bronze_news")
    jobs = {f"n{k}": GateJob(C.RULES["news"], lambda k=k: rows([article(f"a{k}", 1)], RAW), at(1), sequence="seq") for k in range(1)}
    log = {r.source: r for r in runs.run_batch(spark, {**jobs, "broken": broken, "no_sequence": no_sequence}, root, 1).collect()}
    assert log["n0"].status == "success" and log["n0"].records == 1
    assert log["broken"].status == "failed" and "while running" in log["broken"].error
    assert log["no_sequence"].status == "failed" and "sequence" in log["no_sequence"].error
