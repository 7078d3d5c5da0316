"""Enrichment and anomaly operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sieveline.functions import text as X
from sieveline.operators import anomaly, enrich
from sieveline.session import scratch_dir
from workload.fixtures import Inputs
from workload.model_queries import _whole, _fixed, _signed, staged_news_of
from workload.registry import query, r8, rounded


@query(
    "pending_articles",
    """
select article_id, title, ingested_at from fx_bronze_news n
where not exists (select 1 from fx_enriched e where e.article_id = n.article_id)""",
    ("fx_bronze_news", "fx_enriched"),
)
def pending_articles(fx: Inputs) -> DataFrame:
    return enrich.pending_articles(fx.bronze_news, fx.enriched_news).select("article_id", "title", "ingested_at")


_PROMPT = """
concat('Read the market news article below and answer with one JSON object and nothing else.', chr(10), chr(10),
  'Title: ', case when coalesce(title, '') = '' then 'No title' else title end, chr(10),
  'Description: ', substr(case when coalesce(description, '') = '' then 'No description' else description end, 1, 600),
  chr(10), 'Source: ', case when coalesce(source_name, '') = '' then 'Unknown' else source_name end, chr(10),
  'Symbols followed: RELIANCE.NS, TCS.NS, HDFCBANK.NS, INFY.NS, ICICIBANK.NS, HINDUNILVR.NS, SBIN.NS, BAJFINANCE.NS, WIPRO.NS, ADANIENT.NS',
  chr(10), chr(10), 'The object has exactly these keys:', chr(10), 'sentiment: bullish, bearish or neutral', chr(10),
  'confidence: a number from 0 to 1', chr(10),
  'tickers_mentioned: an array of followed symbols the article concerns, possibly empty', chr(10),
  'topic_tags: an array of two to four short lower-case labels', chr(10),
  'market_implication: one sentence on the likely effect on the market')"""


@query("article_prompts", f"select article_id, {_PROMPT} as prompt from fx_bronze_news", ("fx_bronze_news",))
def article_prompts(fx: Inputs) -> DataFrame:
    return enrich.article_prompts(fx.bronze_news)


def stand_in_model(prompt: str) -> str:
    """Answers by prompt length; fails on some prompts, as a service does."""
    if len(prompt) % 7 == 0:
        raise TimeoutError("no answer")
    return f'{{"characters": {len(prompt)}}}'


@query(
    "score_articles",
    f"""
select article_id, case when length(prompt) % 7 <> 0 then concat('{{"characters": ', length(prompt), '}}') end
    as response,
  case when length(prompt) % 7 = 0 then 'TimeoutError: no answer' end as error
from (select article_id, {_PROMPT} as prompt from fx_bronze_news) p""",
    ("fx_bronze_news",),
)
def score_articles(fx: Inputs) -> DataFrame:
    return enrich.score(enrich.article_prompts(fx.bronze_news), stand_in_model)


@query("strip_fences", "select article_id, body from fx_bodies", ("fx_bodies",))
def strip_fences(fx: Inputs) -> DataFrame:
    return fx.responses.select("article_id", X.strip_fences(F.col("response")).alias("body"))


@query(
    "parse_responses",
    """
select article_id, sentiment, confidence, ticker as tickers, topic as topics, market_implication, reject_reason
from fx_parsed""",
    ("fx_parsed",),
)
def parse_responses(fx: Inputs) -> DataFrame:
    return fx.parsed.select(
        "article_id", "sentiment", "confidence", F.array_join("tickers_mentioned", ",").alias("tickers"),
        F.array_join("topic_tags", ",").alias("topics"), "market_implication", "reject_reason",
    )


@query(
    "clamp_confidence",
    """
select doc_id, round(greatest(0.0::double, least(1.0::double, (doc_id % 130) / 100.0::double - 0.1::double)), 8)
  as confidence
from labels""",
)
def clamp_confidence(fx: Inputs) -> DataFrame:
    raw = F.col("doc_id") % 130 / F.lit(100.0) - F.lit(0.1)
    return fx.table("labels").select("doc_id", r8(enrich.clamp(raw.cast("string")), "confidence"))


@query(
    "response_rejects",
    "select reject_reason, count(*) as n_rejected from fx_parsed where reject_reason is not null group by 1",
    ("fx_parsed",),
)
def response_rejects(fx: Inputs) -> DataFrame:
    return enrich.response_rejects(fx.parsed)


def _stats(fx: Inputs) -> DataFrame:
    """A week per bucket, so that the merge of buckets is at work."""
    return anomaly.latest_vs_history(fx.bars, bucket="week")


_HISTORY = """
select ticker, date, close, n_history, round(avg_close, 8) as avg_close, round(std_close, 8) as std_close
from fx_history"""


@query("latest_vs_history", _HISTORY.replace("round(std_close, 8)", "coalesce(round(std_close, 8), 0)") + " where n_history > 0", ("fx_history",))
def latest_vs_history(fx: Inputs) -> DataFrame:
    return rounded(_stats(fx)).filter("n_history > 0")


@query("history_from_states", _HISTORY.replace("round(std_close, 8)", "coalesce(round(std_close, 8), 0)") + " where n_history > 0", ("fx_history",))
def history_from_states(fx: Inputs) -> DataFrame:
    """From states of days that were stored run by run, a day twice; the bars themselves are not read again."""
    path, cut = scratch_dir(fx.spark, "states"), F.to_date(F.lit("2024-01-15"))
    for part in (F.col("date") <= cut, F.col("date") > cut, F.col("date") == cut):
        anomaly.store_states(fx.bars.where(part), path)
    stats = anomaly.latest_from_states(fx.spark.read.parquet(path)).filter("n_history > 0")
    return rounded(stats)


@query("anomaly_guards", _HISTORY + " where n_history >= 5 and std_close <> 0", ("fx_history",))
def anomaly_guards(fx: Inputs) -> DataFrame:
    return rounded(anomaly.enough_history(_stats(fx)))


_FOUND = """
select ticker, date, close, n_history, round(avg_close, 8) as avg_close, round(std_close, 8) as std_close,
  round(pct_change, 8) as pct_change, round(std_devs, 8) as std_devs, direction from fx_anomalies"""


@query("price_anomalies", _FOUND, ("fx_anomalies",))
def price_anomalies(fx: Inputs) -> DataFrame:
    return rounded(anomaly.price_anomalies(_stats(fx)))


@query(
    "new_anomalies",
    """
select sha256(concat_ws('|', ticker, cast(date as varchar))) as anomaly_id, ticker, date, close,
  round(avg_close, 8) as avg_close_30d, round(pct_change, 8) as pct_change, round(std_devs, 8) as std_devs
from fx_anomalies where std_devs < 2.5""",
    ("fx_anomalies",),
)
def new_anomalies(fx: Inputs) -> DataFrame:
    """The strongest moves were recorded by an earlier run."""
    found = anomaly.price_anomalies(_stats(fx))
    recorded = found.filter(F.col("std_devs") >= 2.5).select("ticker", "date")
    rows = anomaly.anomaly_rows(
        anomaly.new_anomalies(found, recorded), F.lit(None), F.lit("2024-02-01 00:00:00")
    )
    return rounded(rows.drop("explanation", "detected_at"))


_OWN = """
select ticker, article_id, title, sentiment, confidence, cast(r as int) as rank
from (select *, row_number() over (partition by ticker order by confidence desc, article_id) as r
      from fx_staged_news where confidence >= 0.5) n where r <= 3"""


@query("symbol_headlines", _OWN, ("fx_staged_news",))
def symbol_headlines(fx: Inputs) -> DataFrame:
    return anomaly.symbol_headlines(staged_news_of(fx)).select(
        "ticker", "article_id", "title", "sentiment", "confidence", "rank"
    )


_BULLET = f"concat('- [', upper(sentiment), ' ', {_whole('confidence')}, '] ', title)"

_CONTEXT = f"""
select a.ticker, a.date, a.close, a.avg_close, a.pct_change, a.std_devs, coalesce(o.lines, m.lines, '') as news_context
from fx_anomalies a
left join (select ticker, string_agg({_BULLET}, chr(10) order by rank) as lines from ({_OWN}) h group by ticker) o
  on a.ticker = o.ticker
left join (select concat('No headline names this symbol. Market-wide signals:', chr(10),
             string_agg({_BULLET}, chr(10) order by confidence desc, article_id)) as lines
           from (select * from fx_staged_news where confidence >= 0.7 and sentiment <> 'neutral'
                 order by confidence desc, article_id limit 3) t) m on true"""


def _context(fx: Inputs) -> DataFrame:
    return anomaly.headline_context(anomaly.price_anomalies(_stats(fx)), staged_news_of(fx))


@query(
    "headline_context",
    f"select ticker, date, news_context from ({_CONTEXT}) c",
    ("fx_anomalies", "fx_staged_news"),
)
def headline_context(fx: Inputs) -> DataFrame:
    return _context(fx).select("ticker", "date", "news_context")


@query(
    "anomaly_prompts",
    f"""
select ticker, date, concat('Explain in one sentence why this close is unusual.', chr(10), chr(10), 'Symbol: ',
  replace(ticker, '.NS', ''), chr(10), 'Close: ₹', cast(close as varchar), chr(10), 'Average of earlier closes: ₹',
  {_fixed('avg_close', 2)}, chr(10), 'Move: ', {_signed('pct_change')}, ' (',
  case when pct_change > 0 then 'above average' else 'below average' end, ')', chr(10),
  'Standard deviations from the average: ', {_fixed('std_devs', 1)}, chr(10), chr(10), 'Headlines:', chr(10),
  case when news_context = '' then 'No headline found for this symbol.' else news_context end, chr(10), chr(10),
  'Name a headline where one fits; otherwise say that no news accounts for the move.') as prompt
from ({_CONTEXT}) c""",
    ("fx_anomalies", "fx_staged_news"),
)
def anomaly_prompts(fx: Inputs) -> DataFrame:
    return anomaly.anomaly_prompts(_context(fx))


@query(
    "reject_reasons",
    """
select cast(doc_id as varchar) as article_id, case doc_id % 8 when 0 then 'no_response' when 1 then 'invalid_json'
    when 2 then 'invalid_json' when 3 then 'missing_fields' when 4 then 'invalid_sentiment'
    when 5 then 'invalid_confidence' end as reject_reason,
  case doc_id % 8 when 6 then cast(1 as double) when 7 then cast(0.5 as double) end as confidence
from documents where doc_id is not null""",
)
def reject_reasons(fx: Inputs) -> DataFrame:
    """Every reason to turn a response down, one that is clamped and one in a fence."""
    kind = F.col("doc_id") % 8
    rest = ',"tickers_mentioned":[],"topic_tags":["a"],"market_implication":"m"}'
    good = F.lit('{"sentiment":"neutral","confidence":')
    response = (
        F.when(kind == 1, "the mood is good").when(kind == 2, '["neutral", 0.5]')
        .when(kind == 3, F.concat(good, F.lit('0.5,"tickers_mentioned":[],"market_implication":"m"}')))
        .when(kind == 4, F.concat(F.lit('{"sentiment":"mixed","confidence":0.5'), F.lit(rest)))
        .when(kind == 5, F.concat(good, F.lit('"high"'), F.lit(rest)))
        .when(kind == 6, F.concat(good, F.lit("1.7"), F.lit(rest)))
        .when(kind == 7, F.concat(F.lit("```json\n"), good, F.lit("0.5"), F.lit(rest), F.lit("\n```")))
    )
    asked = fx.table("documents").where("doc_id is not null").select(F.col("doc_id").cast("string").alias("article_id"), response.alias("response"))
    return enrich.parse_responses(asked).select("article_id", "reject_reason", "confidence")
