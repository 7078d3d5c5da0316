"""Cases the SQL counterparts cannot see: zones, uniqueness, message types, run log, batch stores."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sieveline import config as C
from sieveline.functions import normalize as N, rules as R
from sieveline.operators import enrich, gate
from sieveline.plans import intermediate, runs
from sieveline.schemas import TABLES
from sieveline.session import scratch_dir
from sieveline.sources import snapshots, tables
from sieveline.streaming import ticks as T
from test_stream import NOW, event, texts

STOCKS = C.RULES["stocks"]
DAY = datetime(2024, 3, 5, tzinfo=timezone.utc)
BAR = "ticker string, date string, open double, high double, low double, close double, volume bigint, seq bigint"


def bar(ticker, close, seq, volume=5):
    return (ticker, "2024-03-05", 10.0, 12.0, 9.0, close, volume, seq)


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", ["2024-03-05T01:00:00", "2024-03-05 01:00:00Z", "2024-03-04T20:00:00-05:00", "2024-03-05"])
def test_times_without_zone_are_utc(spark, rows, new_york, text):
    at = rows([(text,)], "t string").select(R.event_time("t", rows([(text,)], "t string").schema["t"].dataType).cast("double")).first()[0]
    assert at - DAY.timestamp() == (0 if text == "2024-03-05" else 3600)


def test_dates_and_days_are_utc_in_any_session(spark, rows, new_york):
    df = rows([("2024-03-05", 1709600400)], "d string, s long").withColumn("t", F.timestamp_seconds("s"))
    kind = df.schema["d"].dataType
    assert df.select(R.event_time("d", kind, date_only=True).cast("double")).first()[0] == DAY.timestamp()
    assert str(df.select(R.utc_day(F.col("t"))).first()[0]) == "2024-03-05"  # 01:00 UTC, the evening before in New York
    results = df.select(F.lit("a").alias("source"), F.col("t").alias("checked_at"), F.lit(True).alias("passed"), F.lit(None).cast("string").alias("failure_code"))
    assert str(intermediate.trust_scores(results).first().date) == "2024-03-05"


def test_records_without_key_are_nobodys_copy(rows):
    rules = C.RULES["ticks"]
    at = (NOW - timedelta(minutes=5)).isoformat()
    data = [(None, "A", at, 1.0, 1.0, 1.0, 1.0, 5, 1), (None, "B", at, 2.0, 2.0, 2.0, 2.0, 5, 2), ("x", "C", at, 2.0, 2.0, 2.0, 2.0, 5, 3), ("x", "C", at, 2.0, 2.0, 2.0, 2.0, 5, 4)]
    df = rows(data, "event_id string, ticker string, timestamp string, open double, high double, low double, close double, volume bigint, seq bigint")
    got = {r.seq: r.failure_code for r in gate.gate(df, rules, NOW, intra_batch="seq").collect()}
    assert got == {1: None, 2: None, 3: None, 4: C.DUPLICATE}


def test_broken_uniqueness_raises(rows):
    known = rows([("A", "2024-03-05"), ("A", "2024-03-05")], "ticker string, date string")
    with pytest.raises(ValueError, match="repeat"):
        gate.gate(rows([bar("A", 1.0, 1)], BAR), STOCKS, DAY, known, verified_unique=True)


def test_two_answers_keep_one_row(rows):
    log = rows([("r1", None), ("r2", "kept")], "record_id string, explanation string")
    answers = rows([("r1", "a"), ("r1", '"b"')], "record_id string, response string")
    assert sorted(map(tuple, enrich.write_back(log, answers).collect())) == [("r1", "a"), ("r2", "kept")]


def test_snapshot_keeps_the_records_source(spark, rows):
    zone = scratch_dir(spark, "zone")
    df = rows([("A", "yfinance")], "ticker string, source string")
    snapshots.write_snapshot(df, zone, "stocks", day="2024-03-05")
    got = snapshots.read_snapshot(spark, zone, df.schema, source="stocks", day="2024-03-05").first()
    assert (got.source, got.feed) == ("yfinance", "stocks")


def test_messages_keep_types_and_unknown_fields(rows):
    sent = json.loads(event(1, open="100.5", volume=7, extra={"a": [1]}))
    bad = json.loads(event(2, volume=-1))
    values = [json.dumps(sent), json.dumps(bad), "no json", "{}"]
    got = [json.loads(r.value) for r in T.messages(T.process(texts(rows, values), NOW)).collect()]
    assert {k: got[0][k] for k in sent} == sent and got[0]["gate_passed"] is True
    assert {k: got[1][k] for k in bad} == bad and got[1]["failure_code"] == C.RANGE_VIOLATION
    assert got[2]["raw_event"] == "no json" and got[2]["gate_passed"] is False
    assert got[3]["failure_code"] == C.SCHEMA_MISSING_FIELD and got[3]["event_id"]


def test_last_written_tick_stays_and_compaction_keeps_it(spark, rows):
    root, target = scratch_dir(spark, "ticks"), scratch_dir(spark, "compacted")
    batches = [[event(1, close=101.0), event(1, close=101.5), event(2)], [event(1, close=102.0), event(3, volume=-1)], [event(4)]]
    for n, values in enumerate(batches):
        T.process(texts(rows, values), NOW).write.partitionBy("gate_passed").parquet(f"{root}/batch_id={n}")
    like = T.process(texts(rows, []), NOW)
    first = T.live_ticks(T.stored(spark, root, like).filter("batch_id = 0"))
    assert {r.event_id: r.close for r in first.collect()} == {"e1": 101.5, "e2": 101.0}
    T.compact(spark, root, like, target, upto=1)
    whole, mixed = T.stored(spark, root, like), T.stored_since(spark, root, like, target, upto=1)
    for table in (T.live_ticks, T.stream_quarantine):
        assert sorted(map(tuple, table(mixed).collect())) == sorted(map(tuple, table(whole).collect()))
    assert {r.event_id: r.close for r in T.live_ticks(mixed).collect()} == {"e1": 102.0, "e2": 101.0, "e4": 101.0}


def test_equal_lines_without_id_stay_events(spark):
    where = scratch_dir(spark, "lines")
    spark.createDataFrame([(event(1, event_id="absent"),)] * 3, "value string").coalesce(1).write.text(where)
    root, checkpoint = scratch_dir(spark, "out"), scratch_dir(spark, "checkpoint")
    stream = T.read_files(spark, where)
    T.start_gate(stream, root, checkpoint, as_of=F.lit(NOW), received_at=F.lit(NOW), once=True).awaitTermination()
    found = T.live_ticks(T.stored(spark, root, T.process(stream, F.lit(NOW), F.lit(NOW))))
    assert found.count() == 3


def test_run_row_is_fixed_and_a_write_without_action_fails(spark, rows):
    df = rows([(1,)], "a int")
    row = tables.logged_run(spark, "r", "s", lambda: df, lambda d: d.count() and None)
    assert row.first().run_at == row.first().run_at and row.first().status == "success"
    idle = tables.logged_run(spark, "r", "s", lambda: df, lambda d: None, wait=0.5).first()
    assert idle.status == "failed" and "no action" in idle.error


def test_batches_and_a_replay(spark, rows):
    root = scratch_dir(spark, "batches")

    def job(*data):
        return {"stocks": runs.GateJob(STOCKS, lambda: rows(list(data), BAR), DAY, table="bronze_stocks", sequence="seq")}

    one = job(bar("A", 1.0, 2), bar("A", 1.5, 7), bar("B", 2.0, 3), bar("C", 3.0, 4, volume=-1))
    two = job(bar("A", 9.0, 1), bar("D", 4.0, 2))
    store, like = runs.BatchStore(spark, root), rows([], BAR).schema
    for batch, jobs in ((1, one), (2, two), (1, one)):
        runs.run_batch(spark, jobs, root, batch)
    stocks = one["stocks"]
    verified = store.verified(stocks, like)
    assert verified.schema == TABLES["bronze_stocks"]
    assert {r.ticker: r.close for r in verified.collect()} == {"A": 1.5, "B": 2.0, "D": 4.0}
    held = {(r.failure_code, json.loads(r.raw_record)["close"]) for r in store.quarantine(stocks, like).collect()}
    assert held == {(C.RANGE_VIOLATION, 3.0), (C.DUPLICATE, 9.0)}
    log = store.gate_log(stocks, like)
    assert log.count() == 6 and log.select("record_id").distinct().count() == 6
    assert sorted((r.batch, r.records, r.status) for r in store.runs().collect()) == [(1, 4, "success"), (2, 2, "success")]
    assert store.decisions(stocks, like).where("passed and raw_record is not null").count() == 0
    trust = intermediate.trust_scores(log)
    assert trust.first().source == "stocks"


def test_link_attributes_and_character_references(rows):
    html = (
        '<a data-href="/9" href="/10">A &amp; B &#8211; &#x20AC; &eacute;</a><a href=/11>bare</a>'
        "<a title='x' HREF='/12'>single &rsquo;</a><a data-href='/13'>none</a>"
    )
    got = N.extract_links(rows([(1, html)], "page_id int, html string"), r"^/(\d+)$", "u/").collect()
    assert [(r.release_id, r.title) for r in got] == [("10", "A & B – € &eacute;"), ("11", "bare"), ("12", "single ’")]


def test_a_failed_build_leaves_the_last_table(spark, rows):
    root = scratch_dir(spark, "models")
    good = {"t": runs.Model("scratch_models", "table", lambda ref: rows([(1,)], "a int"))}
    bad = {"t": runs.Model("scratch_models", "table", lambda ref: rows([(1,)], "a int").select(F.raise_error(F.lit("x")).alias("a")))}
    runs.materialize(spark, good, root)
    with pytest.raises(Exception, match="x"):
        runs.materialize(spark, bad, root)
    assert spark.table("scratch_models.t").count() == 1


def test_a_rebuilt_table_switches_its_location(spark, rows):
    root = scratch_dir(spark, "models")
    build = lambda df: runs.materialize(spark, {"u": runs.Model("scratch_models", "table", lambda ref: df)}, root)
    said, places = [], []
    for df in (rows([(1,)], "a int"), rows([(1,), (2,)], "a int"), rows([("x", 1)], "b string, a int")):
        build(df)
        said.append((spark.table("scratch_models.u").columns, spark.table("scratch_models.u").count()))
        places.append(spark.table("scratch_models.u").inputFiles()[0].rsplit("/", 2)[-2])
    assert said == [(["a"], 1), (["a"], 2), (["b", "a"], 1)] and len(set(places)) == 3


def test_large_numbers_show_in_their_own_form(rows):
    from sieveline.functions import text as X

    df = rows([(1e25,), (12.345,), (None,)], "x double")
    got = [tuple(r) for r in df.select(X.fixed(F.col("x"), 2), X.signed_pct(F.col("x")), X.whole_pct(F.col("x"))).collect()]
    assert got[0][:2] == ("1.0E25", "+1.0E25%") and got[0][2].endswith("E27%")
    assert got[1:] == [("12.35", "+12.35%", "1235%"), (None, None, None)]
