"""Tick events: rules in batch, the same rules on a stream, session calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sieveline import config as C
from sieveline.functions import calendar, normalize as N
from sieveline.session import scratch_dir
from sieveline.streaming import ticks as T
from workload.fixtures import Inputs
from workload.registry import query

def _gated(fx: Inputs) -> DataFrame:
    return T.gate_ticks(fx.tick_records, F.col("as_of"))


_TICKS = "select event_id, failure_code from fx_gated_ticks where {}"


def _code(fx: Inputs, code: str) -> DataFrame:
    return _gated(fx).filter(F.col("failure_code") == code)


@query(
    "tick_gate",
    "select event_id, ticker, failure_code is null as gate_passed, failure_code from fx_gated_ticks",
    ("fx_gated_ticks",),
)
def tick_gate(fx: Inputs) -> DataFrame:
    return _gated(fx).select("event_id", "ticker", "gate_passed", "failure_code")


@query(
    "tick_schema",
    """
select event_id, case when cast(event_id as bigint) % 9 = 0 then 'missing fields: ticker, volume' end as detail
from fx_ticks where cast(event_id as bigint) % 9 = 0""",
    ("fx_ticks",),
)
def tick_schema(fx: Inputs) -> DataFrame:
    """Every ninth event lost two fields on the way."""
    lost = F.col("event_id").cast("bigint") % 9 == 0
    events = fx.tick_records.withColumns(
        {c: F.when(~lost, F.col(c)) for c in ("ticker", "volume")}
    )
    failed = T.gate_ticks(events, F.col("as_of")).filter(F.col("failure_code") == C.SCHEMA_MISSING_FIELD)
    return failed.select("event_id", F.col("failure_detail").alias("detail"))


@query("tick_range", _TICKS.format("failure_code = 'RANGE_VIOLATION'"), ("fx_gated_ticks",))
def tick_range(fx: Inputs) -> DataFrame:
    return _code(fx, C.RANGE_VIOLATION).select("event_id", "failure_code")


@query(
    "tick_bar_move",
    """
select event_id, concat('open=', cast(open as varchar), ' to close=', cast(close as varchar),
  ' moves more than 20% in one bar') as failure_detail
from fx_gated_ticks where open > 0 and high > 0 and low > 0 and close > 0 and volume >= 0 and high >= low
  and abs((close - open) / open) * 100 > 20""",
    ("fx_gated_ticks",),
)
def tick_bar_move(fx: Inputs) -> DataFrame:
    moved = _code(fx, C.RANGE_VIOLATION).filter(F.col("failure_detail").endswith("in one bar"))
    return moved.select("event_id", "failure_detail")


@query("tick_freshness", _TICKS.format("failure_code = 'STALE'"), ("fx_gated_ticks",))
def tick_freshness(fx: Inputs) -> DataFrame:
    return _code(fx, C.STALE).select("event_id", "failure_code")


@query(
    "tick_counts",
    """
select count(*) filter (failure_code is null) as passed, count(*) filter (failure_code is not null) as failed,
  count(*) as total from fx_gated_ticks""",
    ("fx_gated_ticks",),
)
def tick_counts(fx: Inputs) -> DataFrame:
    return T.counts(_gated(fx))


def _messages(fx: Inputs) -> DataFrame:
    """Tick messages with the columns a topic adds; keys on some, identifiers lost on some."""
    n = F.get_json_object("value", "$.event_id").cast("bigint")
    return fx.tick_messages.select(
        F.when(n % 4 == 0, "KEYED").alias("key"),
        F.when(n % 5 == 0, F.regexp_replace("value", '"event_id":"[0-9]+",', "")).otherwise(F.col("value")).alias("value"),
        F.lit("market.ticks.raw").alias("topic"),
        (n % 3).cast("int").alias("partition"),
        n.alias("offset"),
    )


@query(
    "tick_enrich",
    """
select cast(event_id as bigint) as position, cast(event_id as bigint) % 5 <> 0 as own_id,
  case when cast(event_id as bigint) % 4 = 0 then 'KEYED' else coalesce(ticker, 'unknown') end as ticker,
  as_of as received_at from fx_ticks""",
    ("fx_ticks",),
)
def tick_enrich(fx: Inputs) -> DataFrame:
    events = T.process(_messages(fx), F.try_to_timestamp("polled_at"))
    return events.select(
        F.col("offset").alias("position"),
        (F.length("event_id") < 64).alias("own_id"),
        "ticker",
        "received_at",
    )


def _broken_messages(fx: Inputs) -> DataFrame:
    """Every tenth message is cut short."""
    n = F.get_json_object("value", "$.event_id").cast("bigint")
    return fx.tick_messages.select(
        F.lit(None).cast("string").alias("key"),
        F.when(n % 10 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value"),
        F.lit("market.ticks.raw").alias("topic"), F.lit(0).alias("partition"), n.alias("offset"),
    )


@query(
    "stream_decode",
    """
select cast(event_id as bigint) as position, cast(event_id as bigint) % 10 = 0 as malformed,
  case when cast(event_id as bigint) % 10 = 0 then 'SCHEMA_MISSING_FIELD' else failure_code end as failure_code
from fx_gated_ticks""",
    ("fx_gated_ticks",),
)
def stream_decode(fx: Inputs) -> DataFrame:
    events = T.gate_ticks(T.decode(_broken_messages(fx)), F.try_to_timestamp("polled_at"))
    return events.select(
        F.col("offset").alias("position"), F.col("_corrupt_record").isNotNull().alias("malformed"), "failure_code"
    )


def _stream_inputs(fx: Inputs, copies: int = 1) -> str:
    """Tick messages as files for the file source; ``copies`` repeats every message."""
    where = scratch_dir(fx.spark, "stream-in")
    rows = fx.tick_messages
    if copies > 1:
        rows = rows.withColumn("value", F.explode(F.array_repeat("value", copies)))
    rows.write.text(where)
    return where


def _run_once(fx: Inputs, copies: int = 1) -> DataFrame:
    """Gate the messages as a stream until none is left; returns the stored events."""
    stream = T.read_files(fx.spark, _stream_inputs(fx, copies))
    root, checkpoint = scratch_dir(fx.spark, "stream-out"), scratch_dir(fx.spark, "checkpoint")
    check_time = F.try_to_timestamp("polled_at")
    run = T.start_gate(stream, root, checkpoint, as_of=check_time, received_at=check_time, once=True)
    run.awaitTermination()
    return T.stored(fx.spark, root, T.process(stream, check_time, check_time))


@query("stream_source", "select ticker, count(*) as n_events from fx_ticks group by ticker", ("fx_ticks",))
def stream_source(fx: Inputs) -> DataFrame:
    """Events a stream over the message files delivers, by symbol."""
    where, target, checkpoint = (
        _stream_inputs(fx), scratch_dir(fx.spark, "delivered"), scratch_dir(fx.spark, "checkpoint")
    )
    events = T.decode(T.read_files(fx.spark, where)).select("event_id", "ticker")
    run = (
        events.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return fx.spark.read.schema(events.schema).parquet(target).groupBy("ticker").agg(F.count("*").alias("n_events"))


@query(
    "stream_once",
    "select event_id, failure_code is null as gate_passed, failure_code from fx_gated_ticks",
    ("fx_gated_ticks",),
)
def stream_once(fx: Inputs) -> DataFrame:
    return _run_once(fx).select("event_id", "gate_passed", "failure_code")


@query(
    "tick_routes",
    """
select event_id, ticker, case when failure_code is null then 'verified' else 'quarantine' end as route, failure_code,
  as_of as received_at from fx_gated_ticks""",
    ("fx_gated_ticks",),
)
def tick_routes(fx: Inputs) -> DataFrame:
    stored = _run_once(fx)
    live = T.live_rows(stored).select(
        "event_id", "ticker", F.lit("verified").alias("route"), F.lit(None).cast("string").alias("failure_code"),
        "received_at",
    )
    held = T.quarantine_rows(stored).select(
        "event_id", "ticker", F.lit("quarantine").alias("route"), "failure_code",
        F.col("quarantined_at").alias("received_at"),
    )
    return live.unionByName(held)


@query(
    "live_ticks",
    """
select event_id, ticker, bar_timestamp, as_of as polled_at, open, high, low, close, volume, true as gate_passed,
  as_of as received_at from fx_gated_ticks where failure_code is null""",
    ("fx_gated_ticks",),
)
def live_ticks(fx: Inputs) -> DataFrame:
    """Every message delivered twice; the table holds each event once."""
    return T.live_ticks(_run_once(fx, copies=2))


_AGAIN = """
, again as (
  select *, as_of + interval 1 minute as later, close + 0.25 as close_2 from fx_ticks where cast(event_id as bigint) % 7 = 0),
again_passed as (
  select * from again where ticker is not null and bar_timestamp is not null and open > 0 and high > 0 and low > 0
    and close_2 > 0 and volume >= 0 and high >= low and abs((close_2 - open) / open) * 100 <= 20
    and bar_timestamp between later - interval 20 minute and later + interval 2 minute)
select event_id, ticker, bar_timestamp, later as polled_at, open, high, low, close_2 as close, volume, true as gate_passed,
  later as received_at from again_passed
union all
select event_id, ticker, bar_timestamp, as_of, open, high, low, close, volume, true, as_of from fx_gated_ticks
where failure_code is null and event_id not in (select event_id from again_passed)"""


@query("live_table", _AGAIN, ("fx_ticks", "fx_gated_ticks"))
def live_table(fx: Inputs) -> DataFrame:
    """Every event delivered twice, every seventh again a minute later with another close: the stateful stream's table."""
    later = fx.tick_records.filter(F.col("event_id").cast("bigint") % 7 == 0).withColumns(
        {"as_of": F.col("as_of") + F.make_dt_interval(mins=F.lit(1)), "close": F.col("close") + 0.25}
    )
    events = fx.tick_records.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy").unionByName(later)
    events = events.withColumn("polled_at", F.col("as_of").cast("string")).drop("as_of")
    where, root, checkpoint = (scratch_dir(fx.spark, n) for n in ("live-in", "live", "live-checkpoint"))
    events.select(F.to_json(F.struct(*events.columns)).alias("value")).write.text(where)
    stream, check_time = T.read_files(fx.spark, where), F.try_to_timestamp("polled_at")
    T.start_live(stream, root, checkpoint, as_of=check_time, received_at=check_time, once=True).awaitTermination()
    shape = T.live_rows(T.process(_plain_messages(fx), check_time, check_time)).columns
    return T.live_table(fx.spark, root).select(*shape)


@query(
    "stream_counters",
    """
select count(*) filter (failure_code is null) as passed, count(*) filter (failure_code is not null) as failed,
  count(*) as total from fx_gated_ticks""",
    ("fx_gated_ticks",),
)
def stream_counters(fx: Inputs) -> DataFrame:
    """The counters as the stream reports them: metrics of every micro-batch, summed over the query's progress."""
    stream, check_time = T.read_files(fx.spark, _stream_inputs(fx)), F.try_to_timestamp("polled_at")
    root, checkpoint = scratch_dir(fx.spark, "stream-out"), scratch_dir(fx.spark, "checkpoint")
    run = T.start_gate(stream, root, checkpoint, as_of=check_time, received_at=check_time, once=True)
    run.awaitTermination()
    seen = [p.observedMetrics["gate_counts"].asDict() for p in run.recentProgress if "gate_counts" in p.observedMetrics]
    reported = fx.spark.createDataFrame(seen, "passed bigint, failed bigint, total bigint")
    return reported.agg(*[F.sum(c).alias(c) for c in reported.columns])


@query(
    "tick_times",
    """
select event_id, kind, case kind when 1 then 'future' when 2 then 'unreadable' when 3 then null when 4 then null
    when 5 then 'late' end as verdict
from (select *, cast(event_id as bigint) % 6 as kind from fx_ticks) t
where kind > 0 and ticker is not null and open > 0 and high > 0 and low > 0 and close > 0 and volume >= 0
  and high >= low and abs((close - open) / open) * 100 <= 20""",
    ("fx_ticks",),
)
def tick_times(fx: Inputs) -> DataFrame:
    """Plausible ticks with times beyond the limits, exactly on them, and unreadable ones."""
    kind = F.col("event_id").cast("bigint") % 6
    shift = lambda seconds: (F.col("as_of") + F.make_dt_interval(secs=F.lit(seconds))).cast("string")
    moved = (
        F.when(kind == 1, shift(121)).when(kind == 2, F.lit("yesterday noon")).when(kind == 3, shift(120))
        .when(kind == 4, shift(-1200)).otherwise(shift(-1201))
    )
    gated = T.gate_ticks(fx.tick_records.filter(kind > 0).withColumn("timestamp", moved), F.col("as_of"))
    told = F.col("failure_detail")
    verdict = (
        F.when(told.endswith("in the future"), "future").when(told.endswith("not a readable time"), "unreadable")
        .when(told.contains("is older than"), "late")
    )
    plausible = gated.filter(F.col("failure_code").isNull() | (F.col("failure_code") == C.STALE))
    return plausible.select("event_id", kind.alias("kind"), verdict.alias("verdict"))


@query(
    "stream_sink",
    """
select ticker as key, event_id, failure_code is null as gate_passed, failure_code, 'kept' as extra,
  'number' as volume_type from fx_gated_ticks""",
    ("fx_gated_ticks",),
)
def stream_sink(fx: Inputs) -> DataFrame:
    """Keyed messages of both routes, written and read back; a field the gate does not know and types survive."""
    where = scratch_dir(fx.spark, "topic")
    extended = F.regexp_replace("value", r"\}$", ',"extra":"kept","count":7}')
    T.messages(T.process(_plain_messages(fx).withColumn("value", extended), F.try_to_timestamp("polled_at"))).write.partitionBy(
        "gate_passed"
    ).parquet(where)
    sent = fx.spark.read.schema("key string, value string, gate_passed boolean").parquet(where)
    return sent.select(
        "key", F.get_json_object("value", "$.event_id").alias("event_id"), "gate_passed",
        F.get_json_object("value", "$.failure_code").alias("failure_code"),
        F.get_json_object("value", "$.extra").alias("extra"),
        F.when(F.col("value").rlike(r'"count":7[,}]'), "number").otherwise("text").alias("volume_type"),
    )


def _plain_messages(fx: Inputs) -> DataFrame:
    return fx.tick_messages.select(
        F.lit(None).cast("string").alias("key"), "value", F.lit("market.ticks.raw").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
    )


@query(
    "tick_events",
    """
select sha256(concat_ws('|', 'poll-1', ticker)) as event_id, 'poll-1' as poll_id, ticker,
  strftime(bar_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') as timestamp, '2024-02-01T00:00:00Z' as polled_at,
  round(open, 2) as open, round(high, 2) as high, round(low, 2) as low, round(close, 2) as close, volume,
  'intraday_delayed' as source
from fx_ticks qualify row_number() over (partition by ticker order by bar_timestamp desc) = 1""",
    ("fx_ticks",),
)
def tick_events(fx: Inputs) -> DataFrame:
    bars = fx.ticks.withColumnRenamed("bar_timestamp", "timestamp")
    return N.tick_events(bars, "poll-1", F.to_timestamp(F.lit("2024-02-01 00:00:00")))


@query(
    "in_session",
    """
select event_id, isodow(l) <= 5 and hour(l) * 3600 + minute(l) * 60 + second(l) between 33300 and 55800 as in_session
from (select event_id, ts + interval 330 minute as l from events) e""",
)
def in_session(fx: Inputs) -> DataFrame:
    return fx.table("events").select("event_id", calendar.in_session(F.col("ts")).alias("in_session"))


@query(
    "next_session_open",
    """
select event_id, o as next_open, cast(floor((epoch_us(o) - epoch_us(ts)) / 1000000.0) as bigint) as seconds
from (select event_id, ts, cast(cast(l as date) + cast(case
    when isodow(l) <= 5 and hour(l) * 3600 + minute(l) * 60 + second(l) < 33300 then 0
    when isodow(l) = 5 then 3 when isodow(l) = 6 then 2 else 1 end as int) as timestamp)
  + interval 555 minute - interval 330 minute as o
  from (select event_id, ts, ts + interval 330 minute as l from events) e) n""",
)
def next_session_open(fx: Inputs) -> DataFrame:
    ts = F.col("ts")
    return fx.table("events").select(
        "event_id",
        calendar.next_session_open(ts).alias("next_open"),
        calendar.seconds_until_open(ts).alias("seconds"),
    )
