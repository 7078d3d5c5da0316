"""Staging to mart, serving and data tests."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from sieveline import config as C
from sieveline.operators import anomaly, checks
from sieveline.plans import intermediate, mart as M, runs, serving, staging
from sieveline.plans.served import Served
from sieveline.session import scratch_dir
from workload.fixtures import Inputs
from workload.registry import query, r8, rounded
from workload.source_queries import stage_bars


def staged_news_of(fx: Inputs) -> DataFrame:
    return staging.staged_news(fx.bronze_news, fx.enriched_news)


def anomalies_of(fx: Inputs) -> DataFrame:
    found = anomaly.price_anomalies(anomaly.latest_vs_history(fx.bars))
    return anomaly.anomaly_rows(found, F.concat(F.lit("move of "), "ticker"), F.lit("2024-02-01 00:00:00"))


def daily_of(fx: Inputs) -> DataFrame:
    daily = intermediate.daily_bars(stage_bars(fx), anomalies_of(fx))
    return daily.withColumns({c: F.round(c, 8) for c in ("avg_close_7d", "avg_close_30d")})


def sentiment_of(fx: Inputs) -> DataFrame:
    return rounded(intermediate.daily_sentiment(staged_news_of(fx), scale=8))


def trust_of(fx: Inputs) -> DataFrame:
    return intermediate.trust_scores(fx.gate_results, scale=8)


def mart_of(fx: Inputs) -> DataFrame:
    return M.symbol_mart(daily_of(fx), sentiment_of(fx), trust_of(fx), scale=8)


@query(
    "staged_news",
    """
select article_id, title, description, source_name, published_at, ingested_at, sentiment, confidence,
  ticker as tickers, topic as topics, market_implication from fx_staged_news""",
    ("fx_staged_news",),
)
def staged_news(fx: Inputs) -> DataFrame:
    return (
        staged_news_of(fx)
        .withColumns({"tickers": F.array_join("tickers_mentioned", ","), "topics": F.array_join("topic_tags", ",")})
        .drop("_loaded_at", "enriched_at", "tickers_mentioned", "topic_tags")
    )


@query(
    "moving_averages",
    "select ticker, date, close, avg_close_7d, avg_close_30d from fx_daily_bars",
    ("fx_daily_bars",),
)
def moving_averages(fx: Inputs) -> DataFrame:
    rows = intermediate.moving_averages(stage_bars(fx))
    return rows.select("ticker", "date", "close", r8("avg_close_7d"), r8("avg_close_30d"))


@query(
    "moving_averages_by_size",
    "select ticker, date, close, avg_close_7d, avg_close_30d from fx_daily_bars",
    ("fx_daily_bars",),
)
def moving_averages_by_size(fx: Inputs) -> DataFrame:
    """Symbols of more than 20 bars are cut at quantiles of their own dates, the others stay whole."""
    rows = intermediate.moving_averages(stage_bars(fx), bucket="size", most_rows=20)
    return rows.select("ticker", "date", "close", r8("avg_close_7d"), r8("avg_close_30d"))


@query(
    "daily_bars",
    """
select ticker, date, open, high, low, close, volume, price_range, intraday_pct_change, avg_close_7d, avg_close_30d,
  is_anomaly, anomaly_explanation from fx_daily_bars""",
    ("fx_daily_bars",),
)
def daily_bars(fx: Inputs) -> DataFrame:
    return daily_of(fx).drop("_loaded_at")


@query("daily_sentiment", "select * from fx_daily_sentiment", ("fx_daily_sentiment",))
def daily_sentiment(fx: Inputs) -> DataFrame:
    return sentiment_of(fx).drop("_loaded_at")


@query(
    "dominant_sentiment",
    "select dominant_sentiment, count(*) as n_days, cast(sum(article_count) as bigint) as n_articles "
    "from fx_daily_sentiment group by 1",
    ("fx_daily_sentiment",),
)
def dominant_sentiment(fx: Inputs) -> DataFrame:
    return sentiment_of(fx).groupBy("dominant_sentiment").agg(
        F.count("*").alias("n_days"), F.sum("article_count").alias("n_articles")
    )


_LABELLED = """
select doc_id % 40 as d, case (doc_id // 40 + doc_id % 40) % (2 + doc_id % 40 % 3) when 0 then 'bullish' when 1 then 'bearish' else 'neutral' end as label,
  0.25 + 0.25 * (doc_id % 2) as confidence from documents where doc_id is not null"""


@query(
    "dominant_by_day",
    f"""
select date '2024-01-01' + cast(d as int) as date, n as article_count,
  case when bull > bear then 'bullish' when bear > bull then 'bearish' else 'neutral' end as dominant_sentiment
from (select d, count(*) as n, sum(case when label = 'bullish' then confidence else 0 end) as bull,
        sum(case when label = 'bearish' then confidence else 0 end) as bear from ({_LABELLED}) l group by d) s""",
)
def dominant_by_day(fx: Inputs) -> DataFrame:
    """Days led by either direction and days where both weigh the same."""
    doc = F.col("doc_id")
    d = doc % 40
    turn = (F.floor(doc / 40) + d) % (2 + d % 3)
    news = fx.table("documents").where("doc_id is not null").select(
        F.timestamp_seconds(F.lit(1704067200) + d * 86400).alias("published_at"),
        F.when(turn == 0, "bullish").when(turn == 1, "bearish").otherwise("neutral").alias("sentiment"),
        (F.lit(0.25) + F.lit(0.25) * (doc % 2)).alias("confidence"),
    )
    return intermediate.daily_sentiment(news, scale=8).select("date", "article_count", "dominant_sentiment")


@query("trust_scores", "select * from fx_trust", ("fx_trust",))
def trust_scores(fx: Inputs) -> DataFrame:
    return trust_of(fx).drop("_loaded_at")


@query(
    "circuit_breaker",
    """
select source, count(*) as n_days, count(*) filter (is_blocked) as n_blocked,
  min(pass_rate) as worst_pass_rate from fx_trust group by source""",
    ("fx_trust",),
)
def circuit_breaker(fx: Inputs) -> DataFrame:
    return trust_of(fx).groupBy("source").agg(
        F.count("*").alias("n_days"), F.count_if("is_blocked").alias("n_blocked"),
        F.min("pass_rate").alias("worst_pass_rate"),
    )


_MART = (
    "ticker, date, open, high, low, close, volume, price_range, intraday_pct_change, avg_close_7d, avg_close_30d, "
    "pct_from_30d_avg, market_sentiment, bullish_score, bearish_score, article_count, sentiment_confidence, "
    "is_anomaly, anomaly_explanation, stocks_trust_score, stocks_blocked, news_trust_score, news_blocked, "
    "advisor_can_serve"
)


@query("symbol_mart", f"select {_MART} from fx_mart", ("fx_mart",))
def symbol_mart(fx: Inputs) -> DataFrame:
    return mart_of(fx).drop("_loaded_at")


@query("pct_from_avg", "select ticker, date, pct_from_30d_avg from fx_mart", ("fx_mart",))
def pct_from_avg(fx: Inputs) -> DataFrame:
    daily = daily_of(fx)
    pct = M.pct_from_average(F.col("close"), F.col("avg_close_30d"), 8)
    return daily.select("ticker", "date", pct.alias("pct_from_30d_avg"))


@query("latest_trust", "select * from fx_latest_trust", ("fx_latest_trust",))
def latest_trust(fx: Inputs) -> DataFrame:
    trust = trust_of(fx)
    out = M.latest_trust(trust, "stocks")
    for source in ("news", "macro"):
        out = out.unionByName(M.latest_trust(trust, source))
    return out


@query(
    "can_serve",
    """
select date, not (bool_or(is_blocked) filter (source = 'stocks') or bool_or(is_blocked) filter (source = 'news'))
  as can_serve from fx_trust group by date""",
    ("fx_trust",),
)
def can_serve(fx: Inputs) -> DataFrame:
    """The serving flag each day would have had."""
    flags = trust_of(fx).groupBy("date").agg(
        *[F.bool_or(F.when(F.col("source") == s, F.col("is_blocked"))).alias(s) for s in ("stocks", "news")]
    )
    return flags.select("date", M.can_serve([F.col("stocks"), F.col("news")]).alias("can_serve"))


# --- serving ------------------------------------------------------------------


@query("serving_status", "select * from fx_status", ("fx_status",))
def serving_status(fx: Inputs) -> DataFrame:
    return serving.serving_status(mart_of(fx))


_D2 = "cast(round(cast(round({}, 8) as decimal(28,8)), {d}) as decimal(28,{d}))"


def _fixed(expression: str, digits: int) -> str:
    return f"cast({_D2.format(expression, d=digits)} as varchar)"


def _signed(expression: str) -> str:
    value = _D2.format(expression, d=2)
    return f"concat(case when {value} >= 0 then '+' else '' end, cast({value} as varchar), '%')"


def _whole(expression: str) -> str:
    return f"concat(cast(cast(round(cast(round({expression}, 8) as decimal(28,8)) * 100, 0) as bigint) as varchar), '%')"


@query(
    "source_citations",
    " union all ".join(
        f"""
select '{title}' as source, round({name}_trust, 3) as trust_score, coalesce({name}_blocked, false) as is_blocked,
  concat('Trust score: ', {_fixed(name + '_trust * 100', 1)}, '% — ',
    case when {name}_blocked then 'BLOCKED' else 'verified' end) as verified_note
from fx_status where {name}_trust is not null"""
        for name, title in serving.SOURCE_TITLES.items()
    ),
    ("fx_status",),
)
def source_citations(fx: Inputs) -> DataFrame:
    return serving.source_citations(serving.serving_status(mart_of(fx)))


@query(
    "guarded_context",
    """
select m.ticker, m.date, m.close, s.can_serve, not s.can_serve as forced from fx_mart m, fx_status s""",
    ("fx_mart", "fx_status"),
)
def guarded_context(fx: Inputs) -> DataFrame:
    """Forced, so that rows come whatever the breaker says; the real flag stays visible."""
    return serving.guarded_context(mart_of(fx), force=True).select("ticker", "date", "close", "can_serve", "forced")


_CONTEXT = (
    "ticker, date, close, intraday_pct_change, avg_close_7d, avg_close_30d, pct_from_30d_avg, market_sentiment, "
    "bullish_score, bearish_score, sentiment_confidence, is_anomaly, anomaly_explanation, advisor_can_serve"
)


@query("context_symbols", f"select {_CONTEXT} from fx_mart order by ticker, date", ("fx_mart",))
def context_symbols(fx: Inputs) -> DataFrame:
    return serving.context_symbols(mart_of(fx))


_STRONG = "confidence >= 0.7 and sentiment <> 'neutral'"


@query(
    "top_headlines",
    f"""
select article_id, title, sentiment, confidence, market_implication, topic as topics from fx_staged_news
where {_STRONG} order by confidence desc, article_id limit 8""",
    ("fx_staged_news",),
)
def top_headlines(fx: Inputs) -> DataFrame:
    top = serving.top_headlines(staged_news_of(fx))
    return top.withColumn("topics", F.array_join("topic_tags", ",")).drop("topic_tags")


def _names(fx: Inputs) -> DataFrame:
    return fx.table("customer").select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"), F.col("c_name").alias("name")
    )


_NAMED = """
select m.*, coalesce(n.name, m.ticker) as display_name from fx_mart m
left join (select concat('T', cast(c_custkey as varchar)) as ticker, c_name as name from customer) n
  on m.ticker = n.ticker"""


@query(
    "symbol_names",
    """
select distinct b.ticker, coalesce(n.name, b.ticker) as display_name from fx_bars b
left join (select concat('T', cast(c_custkey as varchar)) as ticker, c_name as name from customer) n
  on b.ticker = n.ticker""",
    ("fx_bars",),
)
def symbol_names(fx: Inputs) -> DataFrame:
    return serving.symbol_names(fx.bars.select("ticker").distinct(), _names(fx))


_LINE = f"""
concat(display_name, ' (', replace(ticker, '.NS', ''), '): ₹', cast(close as varchar),
  case when coalesce(intraday_pct_change, 0) <> 0 then concat(' (', {_signed('intraday_pct_change')}, ' intraday)')
    else '' end,
  case when coalesce(avg_close_30d, 0) <> 0 then concat(' | 30d avg ₹', {_fixed('avg_close_30d', 2)}, ' (',
    {_signed('pct_from_30d_avg')}, ')') else '' end,
  case when is_anomaly and coalesce(anomaly_explanation, '') <> '' then concat(' ⚠️ ANOMALY: ', anomaly_explanation)
    else '' end)"""


@query("symbol_lines", f"select ticker, date, {_LINE} as line from ({_NAMED}) n", ("fx_mart",))
def symbol_lines(fx: Inputs) -> DataFrame:
    return serving.symbol_lines(mart_of(fx), _names(fx))


_HEADLINE = (
    f"concat('[', upper(sentiment), ' ', {_whole('confidence')}, '] ', coalesce(title, ''), chr(10), '  → ', "
    "coalesce(market_implication, ''))"
)


@query("headline_lines", f"select article_id, {_HEADLINE} as line from fx_staged_news", ("fx_staged_news",))
def headline_lines(fx: Inputs) -> DataFrame:
    return serving.headline_lines(staged_news_of(fx))


_BLOCKED = "concat_ws(', ', " + ", ".join(
    f"case when {name}_blocked then '{title}' end" for name, title in serving.SOURCE_TITLES.items()
) + ")"


@query(
    "blocked_sources",
    f"""
select case when not can_serve then {_BLOCKED} end as blocked,
  case when not can_serve then concat('No answer now: these sources failed their quality checks: ', {_BLOCKED},
    '. Ask again after the next run.') end as refusal
from fx_status""",
    ("fx_status",),
)
def blocked_sources(fx: Inputs) -> DataFrame:
    return serving.blocked_sources(serving.serving_status(mart_of(fx)))


_BRIEF = f"""
, ranked as (
  select * from (select *, cast(published_at as date) as date, row_number() over (partition by cast(published_at as date)
    order by confidence desc, article_id) as r from fx_staged_news where {_STRONG}) h where r <= 8),
heads as (
  select m.date, max(market_sentiment) as mood, coalesce(max(h.n), 0) as n
  from fx_mart m left join (select date, count(*) as n from ranked group by date) h using (date) group by m.date)
select date as brief_date, 0 as section, 'a' as position, concat('DATA AS OF: ', cast(date as varchar)) as line from heads
union all select date, 0, 'b', 'Every record below passed the quality gate.' from heads
union all select date, 1, '', 'PRICES' from heads
union all select date, 2, '', concat('SENTIMENT: ', upper(coalesce(mood, 'neutral')), ' (', cast(n as varchar),
  case when n = 1 then ' article)' else ' articles)' end) from heads
union all select date, 2, '0000', '{serving.NO_NEWS}' from heads where n = 0
union all select date, 1, ticker, {_LINE} from ({_NAMED}) n
union all select date, 2, lpad(cast(r as varchar), 4, '0'), {_HEADLINE} from ranked where date in (select date from heads)"""


@query(
    "market_brief",
    _BRIEF,
    ("fx_mart", "fx_staged_news"),
)
def market_brief(fx: Inputs) -> DataFrame:
    return serving.market_brief(mart_of(fx), staged_news_of(fx), _names(fx), force=True)


_CHAIN = f"""
{_BRIEF.replace("select date as brief_date, 0 as section, 'a' as position", "select 'served' as state, brief_date, section, position, line from (select date as brief_date, 0 as section, 'a' as position", 1)}) b
union all select 'refused', null, null, null, 'No answer now: these sources failed their quality checks: {serving.SOURCE_TITLES["stocks"]}. Ask again after the next run.'
union all select 'trust', date, cast(records_checked as int), source, cast(is_blocked as varchar) from chain_trust"""


def _chain_sql() -> str:
    """Trust of the chain's own log: bars on the day after their date, then all again when they are stale; articles on their day."""
    log = """
, chain_log as (
  select cast(date + interval 1 day as date) as date, 'stocks' as source, true as ok from fx_bars
  union all select date '2024-06-01', 'stocks', false from fx_bars
  union all select cast(published_at as date), 'news', true from fx_bronze_news),
chain_trust as (
  select date, source, count(*) as records_checked, avg(case when ok then 1.0 else 0.0 end) < 0.85 as is_blocked
  from chain_log group by all)
"""
    return log + _CHAIN


@query("gate_to_brief", _chain_sql(), ("fx_mart", "fx_staged_news", "fx_bronze_news", "fx_bars"))
def gate_to_brief(fx: Inputs) -> DataFrame:
    """From raw records to the served brief: two gate runs, their own log's trust, the mart, two published versions.

    The first run's records are good, so its version is served; in the second all bars are stale, the breaker opens and
    readers get the refusal. Nothing is forced.
    """
    spark, root = fx.spark, scratch_dir(fx.spark, "chain")
    fields = ("ticker", "date", "open", "high", "low", "close", "volume")
    bars = fx.bars.select(*fields, F.col("k").alias("seq"))
    articles = fx.bronze_news.select("article_id", "title", "description", "url", "published_at", "source_name", "ingested_at", F.col("doc_id").alias("seq"))
    fresh = bars.withColumn("checked_at", F.date_add("date", 1).cast("timestamp"))
    stocks = runs.GateJob(C.RULES["stocks"], lambda: fresh, F.col("checked_at"), record_fields=fields, table="bronze_stocks", sequence="seq")
    stale = replace(stocks, records=lambda: fresh, as_of=datetime(2024, 6, 1, tzinfo=timezone.utc))
    news = runs.GateJob(C.RULES["news"], lambda: articles, F.col("published_at"), table="bronze_news", sequence="seq", stable_time=True)
    store, served = runs.BatchStore(spark, f"{root}/store"), Served(spark, f"{root}/served")

    def build(version: int) -> DataFrame:
        log = store.gate_log(stocks, fresh.schema).unionByName(store.gate_log(news, articles.schema))
        trust = intermediate.trust_scores(log, scale=8)
        kept = store.verified(stocks, fresh.schema)
        staged = staging.staged_bars(kept.withColumn("ingested_at", F.col("date").cast("timestamp")), 8, 8)
        found = anomaly.price_anomalies(anomaly.latest_vs_history(kept))
        rows = anomaly.anomaly_rows(found, F.concat(F.lit("move of "), "ticker"), F.lit("2024-02-01 00:00:00"))
        daily = intermediate.daily_bars(staged, rows).withColumns({c: F.round(c, 8) for c in ("avg_close_7d", "avg_close_30d")})
        staged_news = staging.staged_news(store.verified(news, articles.schema), fx.enriched_news)
        sentiment = rounded(intermediate.daily_sentiment(staged_news, scale=8))
        served.publish(version, M.symbol_mart(daily, sentiment, trust, scale=8), staged_news, _names(fx))
        return trust

    runs.run_batch(spark, {"stocks": stocks, "news": news}, f"{root}/store", 1)
    build(1)
    lines = served.brief().select(F.lit("served").alias("state"), "brief_date", "section", "position", "line")
    runs.run_batch(spark, {"stocks": stale}, f"{root}/store", 2)
    trust = build(2)
    refused = served.refusal().where("refusal is not null").select(
        F.lit("refused"), F.lit(None).cast("date"), F.lit(None).cast("int"), F.lit(None).cast("string"), "refusal"
    )
    late = served.brief().select(F.lit("served after all"), "brief_date", "section", "position", "line")
    told = trust.select(F.lit("trust"), "date", F.col("records_checked").cast("int"), "source", F.col("is_blocked").cast("string"))
    return lines.union(late).union(refused).union(told)


# --- data tests ---------------------------------------------------------------


@query(
    "check_not_null",
    """
select 'stg_macro' as model, c as column_name, 'not_null' as test, n as failures from (
  select unnest(['series_id', 'value']) as c,
    unnest([count(*) filter (series_id is null), count(*) filter (value is null)]) as n from fx_macro)
union all
select 'raw_bars', c, 'not_null', n from (
  select unnest(['ticker', 'date', 'close']) as c,
    unnest([count(*) filter (ticker is null), count(*) filter (date is null), count(*) filter (close is null)]) as n
  from fx_raw_bars)
union all
select 'mart', c, 'not_null', n from (
  select unnest(['ticker', 'date', 'close', 'stocks_trust_score', 'advisor_can_serve']) as c,
    unnest([count(*) filter (ticker is null), count(*) filter (date is null), count(*) filter (close is null),
      count(*) filter (stocks_trust_score is null), count(*) filter (advisor_can_serve is null)]) as n from fx_mart)""",
    ("fx_macro", "fx_raw_bars", "fx_mart"),
)
def check_not_null(fx: Inputs) -> DataFrame:
    return checks.union_all(
        [
            checks.not_null(fx.macro, "stg_macro", ["series_id", "value"]),
            checks.not_null(fx.raw_bars, "raw_bars", ["ticker", "date", "close"]),
            checks.not_null(
                mart_of(fx), "mart", ["ticker", "date", "close", "stocks_trust_score", "advisor_can_serve"]
            ),
        ]
    )


@query(
    "check_unique",
    """
select 'stg_news' as model, 'article_id' as column_name, 'unique' as test, count(*) as failures
from (select article_id from fx_staged_news group by 1 having count(*) > 1) n
union all
select 'raw_bars', 'k', 'unique', count(*) from (select k from fx_raw_bars group by 1 having count(*) > 1) b""",
    ("fx_staged_news", "fx_raw_bars"),
)
def check_unique(fx: Inputs) -> DataFrame:
    return checks.unique(staged_news_of(fx), "stg_news", "article_id").unionByName(
        checks.unique(fx.raw_bars, "raw_bars", "k")
    )


@query(
    "check_accepted_values",
    """
select 'stg_news' as model, 'sentiment' as column_name, 'accepted_values' as test,
  count(*) filter (sentiment not in ('bullish', 'bearish', 'neutral')) as failures from fx_staged_news
union all
select 'raw_posts', 'channel', 'accepted_values', count(*) filter (role not in ('user', 'system')) from conversations""",
    ("fx_staged_news",),
)
def check_accepted_values(fx: Inputs) -> DataFrame:
    return checks.accepted_values(staged_news_of(fx), "stg_news", "sentiment", C.SENTIMENTS).unionByName(
        checks.accepted_values(fx.listings, "raw_posts", "channel", ["user", "system"])
    )


_LAYERS = """
select 'gold' as table_schema, 'mart_symbols' as table_name, count(*) as n_rows from fx_mart
union all select 'silver', 'int_trust_score_daily', count(*) from fx_trust
union all select 'silver', 'int_news_sentiment_daily', count(*) from fx_daily_sentiment
union all select 'silver', 'int_stock_daily', count(*) from fx_daily_bars"""


@query("materialize_layers", _LAYERS, ("fx_mart", "fx_trust", "fx_daily_sentiment", "fx_daily_bars"))
def materialize_layers(fx: Inputs) -> DataFrame:
    """Views over staging, stored tables for the rest; the stored tables with their rows."""
    models = runs.layers(
        fx.bars.withColumn("ingested_at", F.col("date")), fx.bronze_news, fx.enriched_news, fx.macro,
        fx.gate_results, anomalies_of(fx),
    )
    inventory = runs.materialize(fx.spark, models, scratch_dir(fx.spark, "layers"))
    stored = inventory.filter((F.col("table_type") == "BASE TABLE") & F.col("table_name").isin(*models))
    return stored.select("table_schema", "table_name", "n_rows")


@query(
    "table_inventory",
    """
select 'audit' as table_schema, 'trust' as table_name, 'BASE TABLE' as table_type, count(*) as n_rows from fx_trust
union all
select '', 'audit_results', 'VIEW', count(*) from fx_gate_results""",
    ("fx_trust", "fx_gate_results"),
)
def table_inventory(fx: Inputs) -> DataFrame:
    models = {
        "results": runs.Model("audit", "view", lambda ref: fx.gate_results),
        "trust": runs.Model("audit", "table", lambda ref: intermediate.trust_scores(ref("results"))),
    }
    inventory = runs.materialize(fx.spark, models, scratch_dir(fx.spark, "inventory"))
    return inventory.filter(F.col("table_name").isin("trust", "audit_results"))


@query(
    "declared_checks",
    """
select 'stg_stocks' as model, c as column_name, 'not_null' as test, 0 as failures from (values ('ticker'), ('date'), ('close')) v(c)
union all select 'stg_news', 'article_id', 'not_null', count(*) filter (article_id is null) from fx_staged_news
union all select 'stg_news', 'sentiment', 'not_null', count(*) filter (sentiment is null) from fx_staged_news
union all select 'stg_news', 'article_id', 'unique', 0
union all select 'stg_news', 'sentiment', 'accepted_values',
  count(*) filter (sentiment not in ('bullish', 'bearish', 'neutral')) from fx_staged_news
union all select 'stg_macro', 'series_id', 'not_null', count(*) filter (series_id is null) from fx_macro where value is not null
union all select 'mart', 'ticker', 'not_null', count(*) filter (ticker is null) from fx_mart
union all select 'mart', 'date', 'not_null', count(*) filter (date is null) from fx_mart
union all select 'mart', 'close', 'not_null', count(*) filter (close is null) from fx_mart
union all select 'mart', 'stocks_trust_score', 'not_null', count(*) filter (stocks_trust_score is null) from fx_mart
union all select 'mart', 'advisor_can_serve', 'not_null', count(*) filter (advisor_can_serve is null) from fx_mart""",
    ("fx_staged_news", "fx_macro", "fx_mart"),
)
def declared_checks(fx: Inputs) -> DataFrame:
    """All thirteen declared tests over the staged models and the mart."""
    models = {
        "stg_stocks": staging.staged_bars(fx.bars.withColumn("ingested_at", F.col("date"))),
        "stg_news": staging.staged_news(fx.bronze_news, fx.enriched_news),
        "stg_macro": staging.staged_macro(fx.macro),
        "mart": mart_of(fx),
    }
    return checks.suite(models)


@query(
    "mart_profile",
    """
select count(*) over () as n_rows, ticker, date, close, market_sentiment, stocks_trust_score, advisor_can_serve
from fx_mart order by ticker, date limit 1""",
    ("fx_mart",),
)
def mart_profile(fx: Inputs) -> DataFrame:
    return checks.mart_profile(mart_of(fx))
