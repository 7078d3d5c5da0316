"""Gate, routes, logs and their stores."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from sieveline import config as C, schemas
from sieveline.operators import dedupe, enrich, gate
from sieveline.functions import normalize as N
from sieveline.plans import runs
from sieveline.session import scratch_dir
from workload.fixtures import Inputs
from workload.registry import query

STOCKS = C.RULES["stocks"]
NEWS_AS_OF = datetime(2024, 1, 30, tzinfo=timezone.utc)
POSTS_AS_OF = datetime(2024, 1, 2, tzinfo=timezone.utc)

_BARS = "select k, copy, failure_code, failure_detail from fx_gated_bars where {} "


def _failures(df: DataFrame, *conditions) -> DataFrame:
    for condition in conditions:
        df = df.filter(condition)
    return df.select("k", "copy", "failure_code", "failure_detail")


def _row_checked(fx: Inputs) -> DataFrame:
    return gate.check(fx.raw_bars, STOCKS, F.col("checked_at"))


_CHECKED = "select k, copy, code as failure_code, detail as failure_detail from fx_checked_bars where {}"


@query("gate_schema", _CHECKED.format("code = 'SCHEMA_MISSING_FIELD'"), ("fx_checked_bars",))
def gate_schema(fx: Inputs) -> DataFrame:
    return _failures(_row_checked(fx), F.col("failure_code") == C.SCHEMA_MISSING_FIELD)


@query("gate_wrong_type", _CHECKED.format("code = 'SCHEMA_WRONG_TYPE'"), ("fx_checked_bars",))
def gate_wrong_type(fx: Inputs) -> DataFrame:
    return _failures(_row_checked(fx), F.col("failure_code") == C.SCHEMA_WRONG_TYPE)


@query("gate_range", _CHECKED.format("code = 'RANGE_VIOLATION'"), ("fx_checked_bars",))
def gate_range(fx: Inputs) -> DataFrame:
    return _failures(_row_checked(fx), F.col("failure_code") == C.RANGE_VIOLATION)


@query("gate_freshness", _CHECKED.format("code = 'STALE' and detail like '% older than %'"), ("fx_checked_bars",))
def gate_freshness(fx: Inputs) -> DataFrame:
    return _failures(
        _row_checked(fx), F.col("failure_code") == C.STALE, F.col("failure_detail").contains(" older than ")
    )


@query("gate_future", _CHECKED.format("code = 'STALE' and detail like '% in the future'"), ("fx_checked_bars",))
def gate_future(fx: Inputs) -> DataFrame:
    return _failures(
        _row_checked(fx), F.col("failure_code") == C.STALE, F.col("failure_detail").endswith(" in the future")
    )


@query("gate_bad_timestamp", _CHECKED.format("code = 'STALE' and detail like '% readable time'"), ("fx_checked_bars",))
def gate_bad_timestamp(fx: Inputs) -> DataFrame:
    return _failures(
        _row_checked(fx), F.col("failure_code") == C.STALE, F.col("failure_detail").endswith(" readable time")
    )


@query("gate_duplicate", _BARS.format("failure_code = 'DUPLICATE'"), ("fx_gated_bars",))
def gate_duplicate(fx: Inputs) -> DataFrame:
    """Against a store whose keys repeat, as an append log before compaction."""
    log = fx.verified_bars.unionByName(fx.verified_bars)
    gated = gate.gate(fx.raw_bars, STOCKS, F.col("checked_at"), log)
    return _failures(gated, F.col("failure_code") == C.DUPLICATE)


@query(
    "gate_decision",
    "select ticker, date, close, volume, k, copy, passed, failure_code, failure_detail from fx_gated_bars",
    ("fx_gated_bars",),
)
def gate_decision(fx: Inputs) -> DataFrame:
    return fx.gated_bars.select(
        "ticker", "date", "close", "volume", "k", "copy", "passed", "failure_code", "failure_detail"
    )


@query(
    "gate_title",
    """
select article_id, case
    when not regexp_full_match(title, '[\\s\\x1c-\\x1f\\x85\\p{Z}]*')
      then case when published_at < timestamp '2024-01-28 00:00:00' then 'STALE'
                when published_at > timestamp '2024-01-30 00:05:00' then 'STALE' end
    else 'RANGE_VIOLATION' end as failure_code
from fx_bronze_news""",
    ("fx_bronze_news",),
)
def gate_title(fx: Inputs) -> DataFrame:
    return gate.check(fx.bronze_news, C.RULES["news"], NEWS_AS_OF).select("article_id", "failure_code")


def _posts(fx: Inputs) -> DataFrame:
    return N.normalize_posts(fx.listings, F.col("channel"))


@query(
    "gate_score",
    """
select post_id, case when try_cast(raw_score as double) is null then 'RANGE_VIOLATION'
    when created_utc < timestamp '2024-01-01 12:00:00' or created_utc > timestamp '2024-01-02 00:05:00' then 'STALE'
  end as failure_code
from (select *, case when num_comments % 7 = 3 then body_snippet else cast(score as varchar) end as raw_score
      from fx_posts) p""",
    ("fx_posts",),
)
def gate_score(fx: Inputs) -> DataFrame:
    texts = F.when(F.col("num_comments") % 7 == 3, F.col("body_snippet")).otherwise(F.col("score").cast("string"))
    posts = _posts(fx).withColumn("score", texts)
    return gate.check(posts, C.RULES["reddit"], POSTS_AS_OF).select("post_id", "failure_code")


@query(
    "gate_results",
    """
select record_id, 'stocks' as source, checked_at, passed, failure_code, cast(null as varchar) as explanation
from fx_identified_bars""",
    ("fx_identified_bars",),
)
def gate_results(fx: Inputs) -> DataFrame:
    return gate.gate_log(fx.identified_bars, STOCKS, F.col("checked_at"))


_QUARANTINE = """
select record_id, 'stocks' as source, checked_at as quarantined_at, failure_code, failure_detail,
  cast(null as varchar) as explanation, raw_record
from fx_identified_bars where not passed"""


def _quarantine(fx: Inputs) -> DataFrame:
    return gate.quarantine_log(fx.identified_bars, STOCKS, F.col("checked_at"))


@query("quarantine_log", _QUARANTINE, ("fx_identified_bars",))
def quarantine_log(fx: Inputs) -> DataFrame:
    return _quarantine(fx)


@query(
    "gate_summary",
    """
select 'stocks' as source, count(*) as total, count(*) filter (passed) as passed,
  count(*) filter (not passed) as failed from fx_gated_bars""",
    ("fx_gated_bars",),
)
def gate_summary(fx: Inputs) -> DataFrame:
    return gate.summary(fx.gated_bars, "stocks")


@query(
    "route_passed",
    "select ticker, date, open, high, low, close, volume, copy from fx_gated_bars where passed",
    ("fx_gated_bars",),
)
def route_passed(fx: Inputs) -> DataFrame:
    return gate.passed_records(fx.gated_bars, [*fx.bar_fields, "copy"])


@query(
    "route_failed",
    """
select ticker, date, open, high, low, close, volume, copy, failure_code as _failure_code,
  failure_detail as _failure_detail from fx_gated_bars where not passed""",
    ("fx_gated_bars",),
)
def route_failed(fx: Inputs) -> DataFrame:
    return gate.failed_records(fx.gated_bars, [*fx.bar_fields, "copy"])


@query(
    "verified_bars",
    """
select ticker, cast(date as date) as date, open, high, low, max(cast(close as double) + copy) as close, volume,
  checked_at as ingested_at, concat('stocks/', strftime(checked_at, '%Y-%m-%d')) as source_file
from fx_gated_bars where passed group by all""",
    ("fx_gated_bars",),
)
def verified_bars(fx: Inputs) -> DataFrame:
    """Copies of a key differ in their close; the last to arrive stays."""
    passed = fx.gated_bars.filter("passed").withColumn("close", F.col("close").cast("double") + F.col("copy"))
    last = dedupe.upsert_latest(passed, ["ticker", "date"], ["checked_at", "copy"])
    return gate.verified_rows(
        last,
        schemas.TABLES["bronze_stocks"],
        {
            "ingested_at": F.col("checked_at"),
            "source_file": F.concat(F.lit("stocks/"), F.date_format("checked_at", "yyyy-MM-dd")),
        },
    )


@query(
    "gate_all_sources",
    """
select 'stocks' as source, count(*) as total, count(*) filter (passed) as passed,
  count(*) filter (not passed) as failed, cast(null as varchar) as error from fx_gated_bars
union all
select 'news', count(*), count(*) filter (ok), count(*) filter (not ok), null
from (select not regexp_full_match(title, '[\\s\\x1c-\\x1f\\x85\\p{Z}]*')
    and published_at between timestamp '2024-01-28 00:00:00' and timestamp '2024-01-30 00:05:00' as ok
  from fx_bronze_news) n
union all
select 'macro', count(*), count(*) filter (ok), count(*) filter (not ok), null
from (select not regexp_full_match(title, '[\\s\\x1c-\\x1f\\x85\\p{Z}]*') as ok from fx_links) l
union all
select 'reddit', count(*), count(*) filter (ok), count(*) filter (not ok), null
from (select created_utc between timestamp '2024-01-01 12:00:00' and timestamp '2024-01-02 00:05:00' as ok
  from fx_posts) p
union all
select 'absent', null, null, null, 'AnalysisException'""",
    ("fx_gated_bars", "fx_bronze_news", "fx_links", "fx_posts"),
)
def gate_all_sources(fx: Inputs) -> DataFrame:
    jobs = {
        "stocks": runs.GateJob(
            STOCKS, lambda: fx.raw_bars, F.col("checked_at"), lambda: fx.verified_bars, record_fields=fx.bar_fields
        ),
        "news": runs.GateJob(C.RULES["news"], lambda: fx.bronze_news, NEWS_AS_OF),
        "macro": runs.GateJob(
            C.RULES["macro"], lambda: links(fx).withColumn("scraped_at", F.lit("2024-01-29T12:00:00Z")), NEWS_AS_OF
        ),
        "reddit": runs.GateJob(C.RULES["reddit"], lambda: _posts(fx), POSTS_AS_OF),
        "absent": runs.GateJob(STOCKS, lambda: fx.table("no_such_table"), NEWS_AS_OF),
    }
    found = runs.gate_all_sources(fx.spark, jobs, scratch_dir(fx.spark, "gate"))
    return found.withColumn("error", F.split_part("error", F.lit(":"), F.lit(1)))


_BATCHES = """
select 'verified' as kind, ticker, date, case when k % 3 = 0 then volume + 1 else volume end as n, cast(null as varchar) as code
from fx_bars
union all select 'verified', 'N' || ticker, date, volume, null from fx_bars where k % 5 = 0
union all select 'quarantine', ticker, date, volume + 10, 'DUPLICATE' from fx_bars where k % 2 = 0
union all select 'quarantine', 'X' || ticker, date, -1, 'RANGE_VIOLATION' from fx_bars where k % 7 = 0
union all select 'log', null, null, count(*) + count(*) filter (k % 3 = 0) + count(*) filter (k % 5 = 0), 'passed' from fx_bars
union all select 'log', null, null, count(*), 'DUPLICATE' from fx_bars where k % 2 = 0 having count(*) > 0
union all select 'log', null, null, count(*), 'RANGE_VIOLATION' from fx_bars where k % 7 = 0 having count(*) > 0
union all select 'run', 'stocks-1', null, count(*) + count(*) filter (k % 3 = 0), 'success' from fx_bars
union all select 'run', 'stocks-2', null, count(*) filter (k % 2 = 0) + count(*) filter (k % 5 = 0) + count(*) filter (k % 7 = 0),
  'success' from fx_bars"""


@query("gate_two_batches", _BATCHES, ("fx_bars",))
def gate_two_batches(fx: Inputs) -> DataFrame:
    """A batch with differing copies of keys, a later one that repeats keys, then the first again."""
    fields = ["ticker", "date", "open", "high", "low", "close", "volume"]
    bars = fx.bars.select(*fields, "k")
    copies = F.when(F.col("k") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    one = bars.select("*", F.explode(copies).alias("c")).withColumns(
        {"volume": F.col("volume") + F.col("c"), "seq": F.col("k") * 2 + F.col("c")}
    )
    again = bars.filter("k % 2 = 0").withColumn("volume", F.col("volume") + 10)
    new = bars.filter("k % 5 = 0").withColumn("ticker", F.concat(F.lit("N"), "ticker"))
    bad = bars.filter("k % 7 = 0").withColumns({"ticker": F.concat(F.lit("X"), "ticker"), "volume": F.lit(-1).cast("bigint")})
    two = again.unionByName(new).unionByName(bad).withColumn("seq", F.col("k"))

    def job(records: DataFrame) -> runs.GateJob:
        timed = records.select(*fields, "seq").withColumn("checked_at", F.col("date").cast("timestamp"))
        return runs.GateJob(
            STOCKS, lambda: timed, F.col("checked_at"), record_fields=tuple(fields), table="bronze_stocks", sequence="seq"
        )

    root = scratch_dir(fx.spark, "batches")
    for batch, records in ((1, one), (2, two), (1, one)):
        runs.run_batch(fx.spark, {"stocks": job(records)}, root, batch)
    store, like = runs.BatchStore(fx.spark, root), job(one).records().schema
    stocks, no_day = job(one), F.lit(None).cast("date").alias("date")
    held = store.quarantine(stocks, like)
    text = lambda name: F.get_json_object("raw_record", f"$.{name}")
    log = store.gate_log(stocks, like).groupBy(F.coalesce("failure_code", F.lit("passed")).alias("code")).count()
    code = F.lit(None).cast("string").alias("code")
    parts = [
        store.verified(stocks, like).select(F.lit("verified").alias("kind"), "ticker", "date", F.col("volume").alias("n"), code),
        held.select(F.lit("quarantine"), text("ticker"), text("date").cast("date"), text("volume").cast("bigint"), "failure_code"),
        log.select(F.lit("log"), F.lit(None).cast("string"), no_day, "count", "code"),
        store.runs().select(F.lit("run"), F.concat_ws("-", "source", "batch"), no_day, "records", "status"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


_WINDOW_BATCHES = """
, b as (select b, timestamp '2024-01-09 00:00:00' + to_days(cast(b as int)) as as_of from range(1, 5) t(b)),
judged as (
  select b, article_id, published_at, case
      when doc_id % 11 = 3 then 'RANGE_VIOLATION'
      when published_at < as_of - interval 48 hour or published_at > as_of + interval 5 minute then 'STALE'
      when b > 1 and published_at <= as_of - interval 1 day + interval 5 minute then 'DUPLICATE' end as code
  from fx_bronze_news, b)
select 'decision' as kind, cast(b as bigint) as batch, article_id, code from judged
union all select 'verified', cast(null as bigint), article_id, null from judged where code is null"""


@query("gate_window_batches", _WINDOW_BATCHES, ("fx_bronze_news",))
def gate_window_batches(fx: Inputs) -> DataFrame:
    """Articles, whose key holds no date, offered to four daily batches; each lookup reads the days of its window only.

    The first batch runs again at the end and changes nothing; the first two are folded together.
    """
    raw = fx.bronze_news.withColumn("title", F.when(F.col("doc_id") % 11 == 3, " \t ").otherwise(F.concat(F.lit("x"), "title")))
    raw = raw.select("article_id", "title", "url", "published_at", F.col("doc_id").alias("seq"))

    def job(batch: int) -> runs.GateJob:
        at = datetime(2024, 1, 9 + batch, tzinfo=timezone.utc)
        return runs.GateJob(C.RULES["news"], lambda: raw, at, table="bronze_news", sequence="seq", stable_time=True)

    root = scratch_dir(fx.spark, "window-batches")
    for batch in (1, 2, 3, 4, 1):
        runs.run_batch(fx.spark, {"news": job(batch)}, root, batch)
    store = runs.BatchStore(fx.spark, root)
    store.fold(job(1), raw.schema, upto=2)
    decisions = store.decisions(job(1), raw.schema).select(F.lit("decision").alias("kind"), "batch", "article_id", F.col("failure_code").alias("code"))
    verified = store.verified(job(1), raw.schema).select(F.lit("verified"), F.lit(None).cast("bigint"), "article_id", F.lit(None).cast("string"))
    return decisions.union(verified)


def links(fx: Inputs) -> DataFrame:
    return N.extract_links(fx.table("pages"), r"^/(.+)$", "https://example.org/")


_PENDING = f"""
select record_id, source, quarantined_at, failure_code, failure_detail, explanation, raw_record
from ({_QUARANTINE}) q order by quarantined_at, record_id limit 5"""


@query("pending_explanations", _PENDING, ("fx_identified_bars",))
def pending_explanations(fx: Inputs) -> DataFrame:
    return enrich.pending_explanations(_quarantine(fx), limit=5)


@query(
    "explanation_prompts",
    f"""
select record_id, concat('Explain in one sentence to a colleague why this ', source, ' record was rejected.', chr(10),
  chr(10), 'Code: ', failure_code, chr(10), 'Detail: ', failure_detail, chr(10), 'Record: ', substr(raw_record, 1, 800),
  chr(10), chr(10), 'Mention the values involved. Answer with the sentence only.') as prompt
from ({_QUARANTINE}) q""",
    ("fx_identified_bars",),
)
def explanation_prompts(fx: Inputs) -> DataFrame:
    return enrich.explanation_prompts(_quarantine(fx))


@query(
    "quarantine_writeback",
    f"""
select record_id, source, quarantined_at, failure_code, failure_detail,
  case when failure_code = 'STALE' then concat('late: ', failure_detail) end as explanation, raw_record
from ({_QUARANTINE}) q""",
    ("fx_identified_bars",),
)
def quarantine_writeback(fx: Inputs) -> DataFrame:
    log = _quarantine(fx)
    answers = log.filter(F.col("failure_code") == C.STALE).select(
        "record_id", F.concat(F.lit("\"'late: "), "failure_detail", F.lit("'\"")).alias("response")
    )
    return enrich.write_back(log, answers)




@query(
    "upsert_latest",
    """
select ticker, date, case when k % 3 = 0 then round(close + 1, 8) else close end as close, volume,
  case when k % 3 = 0 then 2 else 1 end as version
from fx_bars""",
    ("fx_bars",),
)
def upsert_latest(fx: Inputs) -> DataFrame:
    """Every bar is logged once, every third again with another close; two appends, one compaction."""
    from sieveline.sources import tables

    root = scratch_dir(fx.spark, "log")
    fields = ["ticker", "date", "close", "volume"]
    bars = fx.bars
    tables.append(bars.select(*fields, F.lit(1).alias("version")), f"{root}/log")
    again = bars.filter(F.col("k") % 3 == 0).withColumn("close", F.round(F.col("close") + 1, 8))
    tables.append(again.select(*fields, F.lit(2).alias("version")), f"{root}/log")
    tables.compact(fx.spark, f"{root}/log", f"{root}/compacted", ["ticker", "date"], ["version"])
    return fx.spark.read.parquet(f"{root}/compacted")
