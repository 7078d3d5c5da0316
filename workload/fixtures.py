"""Inputs of the registered queries, derived from the given tables.

``Inputs`` builds them with Spark; ``SQL`` holds the same views for DuckDB. Every
view reads its whole table and whole texts. The modulo expressions below place
known faults, they do not thin rows out.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline import config as C
from sieveline.operators import enrich, gate
from sieveline.session import prepare


# Columns of the given tables in their stored types: a declared schema spares reading
# file footers before the first plan.
COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in COLUMNS:
            reader = reader.schema(COLUMNS[name])
        return reader.parquet(self.path(name))

    @cached_property
    def bars(self) -> DataFrame:
        """Daily bars from events: (user, day) in one map-side combined aggregate."""
        at = F.struct("ts", "event_id")
        return (
            self.table("events")
            .groupBy(
                F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"),
                F.to_date("ts").alias("date"),
            )
            .agg(
                F.min_by("value", at).alias("open"),
                F.max("value").alias("high"),
                F.min("value").alias("low"),
                F.max_by("value", at).alias("close"),
                F.count("*").alias("volume"),
                F.min("event_id").alias("k"),
            )
        )

    @cached_property
    def raw_bars(self) -> DataFrame:
        """Bars as received, with one fault per class of k."""
        k = F.col("k") % 40
        day = F.col("date")
        copies = F.when(k == 10, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        text = lambda d: d.cast("string")
        close = F.col("close").cast("string")
        return self.bars.select(
            F.when(k != 0, F.col("ticker")).alias("ticker"),
            F.when(k == 5, text(F.date_sub(day, 10)))
            .when(k == 6, text(F.date_add(day, 10)))
            .when(k == 7, "not-a-date")
            .otherwise(text(day))
            .alias("date"),
            "open",
            F.when(k == 3, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
            "low",
            F.when(k == 1, None).when(k == 8, "abc").when(k == 2, F.concat(F.lit("-"), close)).otherwise(close).alias(
                "close"
            ),
            F.when(k == 4, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
            F.date_add(day, 1).cast("timestamp").alias("checked_at"),
            "k",
            F.explode(copies).alias("copy"),
        )

    @cached_property
    def verified_bars(self) -> DataFrame:
        """Bars an earlier run verified."""
        return self.bars.filter((F.col("k") % 40).isin(9, 11)).select(
            "ticker", "date", "open", "high", "low", "close", "volume"
        )

    bar_fields = ("ticker", "date", "open", "high", "low", "close", "volume")

    @cached_property
    def gated_bars(self) -> DataFrame:
        return gate.gate(
            self.raw_bars, C.RULES["stocks"], F.col("checked_at"), self.verified_bars, verified_unique=True, check_unique=False
        )

    @cached_property
    def identified_bars(self) -> DataFrame:
        seq = self.gated_bars.withColumn("seq", F.concat_ws("-", "k", "copy"))
        return gate.identify(seq, C.RULES["stocks"], list(self.bar_fields), "seq")

    @cached_property
    def bronze_news(self) -> DataFrame:
        url = F.concat(F.lit("https://example.org/doc/"), F.col("doc_id").cast("string"))
        days = F.make_dt_interval((F.col("doc_id") % 30).cast("int"))
        published = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + days
        return self.table("documents").select(
            F.md5(url).alias("article_id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.col("text").alias("description"),
            url.alias("url"),
            published.alias("published_at"),
            F.col("source").alias("source_name"),
            (published + F.make_dt_interval(hours=F.lit(1))).alias("ingested_at"),
            "lang",
            "doc_id",
        )

    @cached_property
    def responses(self) -> DataFrame:
        """Model answers as received: fenced, keyless, wrong label, confidence out of range."""
        doc = F.col("doc_id")
        fenced = doc % 11 == 0
        label = (
            F.when(doc % 17 == 0, "mixed")
            .when(F.col("toxic") == 1, "bearish")
            .when(F.col("quality") == 1, "bullish")
            .otherwise("neutral")
        )
        confidence = ((doc % 130) / F.lit(100.0) - F.lit(0.1)).cast("decimal(4,2)").cast("string")
        raw = F.concat(
            F.when(fenced, "```json ").otherwise(""),
            F.lit('{"sentiment":"'), label, F.lit('","confidence":'), confidence,
            F.lit(',"tickers_mentioned":["T'), (doc % 150).cast("string"), F.lit('"],"topic_tags":["'),
            F.when(doc % 2 == 0, "earnings").otherwise("policy"), F.lit('"]'),
            F.when(doc % 13 == 0, "").otherwise(',"market_implication":"m"'), F.lit("}"),
            F.when(fenced, " ```").otherwise(""),
        )
        url = F.concat(F.lit("https://example.org/doc/"), doc.cast("string"))
        return self.table("labels").select(F.md5(url).alias("article_id"), "doc_id", raw.alias("response"))

    @cached_property
    def parsed(self) -> DataFrame:
        return enrich.parse_responses(self.responses)

    @cached_property
    def enriched_news(self) -> DataFrame:
        return enrich.enriched_rows(self.parsed, F.lit("2024-02-01 00:00:00"))

    @cached_property
    def gate_results(self) -> DataFrame:
        event, user = F.col("event_id"), F.col("user_id")
        passed = event % (5 + F.dayofmonth("ts") % 4) != 0
        codes = F.array(
            *[F.lit(c) for c in (C.SCHEMA_MISSING_FIELD, C.SCHEMA_WRONG_TYPE, C.RANGE_VIOLATION, C.STALE, C.DUPLICATE)]
        )
        return self.table("events").select(
            F.concat(event.cast("string"), F.lit("-g")).alias("record_id"),
            F.when(user % 3 == 0, "stocks").when(user % 3 == 1, "news").otherwise("macro").alias("source"),
            F.col("ts").cast("timestamp").alias("checked_at"),
            passed.alias("passed"),
            F.when(~passed, F.element_at(codes, (event % 5 + 1).cast("int"))).alias("failure_code"),
        )

    @cached_property
    def macro(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderpriority").alias("series_id"),
            F.to_date("o_orderdate").alias("date"),
            F.when(F.col("o_orderkey") % 20 != 0, F.col("o_totalprice")).alias("value"),
            F.col("o_orderdate").cast("timestamp").alias("ingested_at"),
            F.col("o_orderkey").alias("k"),
        )

    @cached_property
    def listings(self) -> DataFrame:
        """Forum listing pages: each turn as the only child of its page."""
        turn = F.col("turn")
        data = F.struct(
            F.concat_ws("_", F.col("conv_id").cast("string"), turn.cast("string")).alias("id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.when(turn % 5 != 0, F.length("text")).alias("score"),
            turn.alias("num_comments"),
            F.lit(None).cast("double").alias("upvote_ratio"),
            (F.lit(1704067200) + F.col("conv_id") * 3600).alias("created_utc"),
            F.col("text").alias("selftext"),
            (turn == 0).alias("stickied"),
        )
        children = F.struct(F.array(F.struct(data.alias("data"))).alias("children"))
        return self.table("conversations").select(children.alias("data"), F.col("role").alias("channel"))

    @cached_property
    def ticks(self) -> DataFrame:
        minutes = F.make_dt_interval(mins=(F.col("event_id") % 30).cast("int"))
        at = F.col("ts").cast("timestamp")
        value = F.col("value")
        return self.table("events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("event_type").alias("ticker"),
            at.alias("bar_timestamp"),
            value.alias("open"),
            (value + 1.0).alias("high"),
            (value - 0.25).alias("low"),
            (value + (F.col("event_id") % 5) * F.lit(0.25)).alias("close"),
            (F.get_json_object("props", "$.k").cast("bigint") - 5).alias("volume"),
            (at + minutes).alias("as_of"),
        )

    @cached_property
    def tick_records(self) -> DataFrame:
        """Ticks as events with the check time beside them."""
        return self.ticks.select(
            "event_id", "ticker", F.col("bar_timestamp").cast("string").alias("timestamp"),
            "open", "high", "low", "close", "volume", "as_of",
        )

    @cached_property
    def tick_messages(self) -> DataFrame:
        """Ticks as JSON messages; the check time travels as ``polled_at``."""
        event = self.tick_records.withColumn("polled_at", F.col("as_of").cast("string")).drop("as_of")
        return event.select(F.explode(F.array(F.to_json(F.struct(*event.columns)))).alias("value"))



# View name -> (text, views it reads). DuckDB dialect.
SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_bars": (
        """
select concat('T', cast(user_id as varchar)) as ticker, cast(ts as date) as date,
  max(case when rn_a = 1 then value end) as open, max(value) as high, min(value) as low,
  max(case when rn_d = 1 then value end) as close, count(*) as volume, min(event_id) as k
from (select *,
        row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) as rn_a,
        row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as rn_d
      from events) e
group by user_id, cast(ts as date)""",
        (),
    ),
    "fx_raw_bars": (
        """
select case when k % 40 = 0 then null else ticker end as ticker,
  case when k % 40 = 5 then cast(cast(date - interval 10 day as date) as varchar)
       when k % 40 = 6 then cast(cast(date + interval 10 day as date) as varchar)
       when k % 40 = 7 then 'not-a-date' else cast(date as varchar) end as date,
  open, case when k % 40 = 3 then low - 1 else high end as high, low,
  case when k % 40 = 1 then null when k % 40 = 8 then 'abc'
       when k % 40 = 2 then concat('-', cast(close as varchar)) else cast(close as varchar) end as close,
  case when k % 40 = 4 then -volume else volume end as volume,
  cast(date as timestamp) + interval 1 day as checked_at, k, copy
from fx_bars cross join (select 0 as copy union all select 1 as copy) c
where copy = 0 or k % 40 = 10""",
        ("fx_bars",),
    ),
    "fx_verified_bars": (
        "select ticker, date, open, high, low, close, volume from fx_bars where k % 40 in (9, 11)",
        ("fx_bars",),
    ),
    "fx_checked_bars": (
        """
select *, case
    when ticker is null or date is null or open is null or high is null or low is null or close is null
      or volume is null then 'SCHEMA_MISSING_FIELD'
    when num is null then 'SCHEMA_WRONG_TYPE'
    when open <= 0 or isnan(open) or high <= 0 or isnan(high) or low <= 0 or isnan(low) or num <= 0 or isnan(num)
      or volume < 0 or high < low then 'RANGE_VIOLATION'
    when bar_day is null or bar_day < checked_at - interval 3 day or bar_day > checked_at + interval 5 minute then 'STALE'
  end as code,
  case
    when ticker is null or date is null or open is null or high is null or low is null or close is null
      or volume is null
      then concat('missing fields: ', concat_ws(', ', case when ticker is null then 'ticker' end,
        case when date is null then 'date' end, case when open is null then 'open' end,
        case when high is null then 'high' end, case when low is null then 'low' end,
        case when close is null then 'close' end, case when volume is null then 'volume' end))
    when num is null then concat('not a number: close=', close)
    when open <= 0 or isnan(open) then concat('open=', cast(open as varchar), ' is not a price above zero')
    when high <= 0 or isnan(high) then concat('high=', cast(high as varchar), ' is not a price above zero')
    when low <= 0 or isnan(low) then concat('low=', cast(low as varchar), ' is not a price above zero')
    when num <= 0 or isnan(num) then concat('close=', close, ' is not a price above zero')
    when volume < 0 then concat('volume=', cast(volume as varchar), ' is negative')
    when high < low then concat('high=', cast(high as varchar), ' is below low=', cast(low as varchar))
    when bar_day is null then concat('date=', date, ' is not a readable time')
    when bar_day < checked_at - interval 3 day then concat('date=', date, ' is older than 3 days')
    when bar_day > checked_at + interval 5 minute then concat('date=', date, ' is more than 5 minutes in the future')
  end as detail
from (select *, try_cast(close as double) as num, try_strptime(date, '%Y-%m-%d') as bar_day from fx_raw_bars) r""",
        ("fx_raw_bars",),
    ),
    "fx_gated_bars": (
        """
select ticker, date, open, high, low, close, volume, checked_at, k, copy, num,
  coalesce(code, case when known then 'DUPLICATE' end) as failure_code,
  coalesce(detail, case when known then concat('ticker=', ticker, ', date=', date, ' is already verified') end)
    as failure_detail,
  code is null and not known as passed
from (select c.*, code is null and exists (select 1 from fx_verified_bars v
        where v.ticker = c.ticker and v.date = cast(c.bar_day as date)) as known
      from fx_checked_bars c) g""",
        ("fx_checked_bars", "fx_verified_bars"),
    ),
    "fx_identified_bars": (
        """
select *, sha256(concat_ws('|', 'stocks', raw_record, concat_ws('-', cast(k as varchar), cast(copy as varchar))))
    as record_id
from (select *, cast(to_json(struct_pack(ticker := ticker, date := date, open := open, high := high, low := low,
        close := close, volume := volume)) as varchar) as raw_record from fx_gated_bars) r""",
        ("fx_gated_bars",),
    ),
    "fx_bronze_news": (
        """
select md5(concat('https://example.org/doc/', cast(doc_id as varchar))) as article_id,
  split_part(text, chr(10), 1) as title, text as description,
  concat('https://example.org/doc/', cast(doc_id as varchar)) as url,
  timestamp '2024-01-01 00:00:00' + (doc_id % 30) * interval 1 day as published_at,
  source as source_name,
  timestamp '2024-01-01 01:00:00' + (doc_id % 30) * interval 1 day as ingested_at, lang, doc_id
from documents""",
        (),
    ),
    "fx_responses": (
        """
select md5(concat('https://example.org/doc/', cast(doc_id as varchar))) as article_id, doc_id,
  concat(case when doc_id % 11 = 0 then '```json ' else '' end, '{"sentiment":"',
    case when doc_id % 17 = 0 then 'mixed' when toxic = 1 then 'bearish' when quality = 1 then 'bullish'
         else 'neutral' end,
    '","confidence":', cast(cast((doc_id % 130) / 100.0 - 0.1 as decimal(4,2)) as varchar),
    ',"tickers_mentioned":["T', cast(doc_id % 150 as varchar), '"],"topic_tags":["',
    case when doc_id % 2 = 0 then 'earnings' else 'policy' end, '"]',
    case when doc_id % 13 = 0 then '' else ',"market_implication":"m"' end, '}',
    case when doc_id % 11 = 0 then ' ```' else '' end) as response
from labels""",
        (),
    ),
    "fx_bodies": (
        """
select article_id, response, case when starts_with(trim(response), '```')
    then trim(regexp_replace(split_part(trim(response), '```', 2), '^json', '')) else trim(response) end as body
from fx_responses""",
        ("fx_responses",),
    ),
    "fx_parsed": (
        """
select article_id, reject_reason,
  case when reject_reason is null then json_extract_string(body, '$.sentiment') end as sentiment,
  case when reject_reason is null
    then greatest(0.0::double, least(1.0::double, try_cast(json_extract_string(body, '$.confidence') as double))) end
    as confidence,
  case when reject_reason is null then json_extract_string(body, '$.tickers_mentioned[0]') end as ticker,
  case when reject_reason is null then json_extract_string(body, '$.topic_tags[0]') end as topic,
  case when reject_reason is null then json_extract_string(body, '$.market_implication') end as market_implication
from (select *, case
    when not json_valid(body) then 'invalid_json'
    when not list_has_all(json_keys(body),
      ['sentiment', 'confidence', 'tickers_mentioned', 'topic_tags', 'market_implication']) then 'missing_fields'
    when json_extract_string(body, '$.sentiment') not in ('bullish', 'bearish', 'neutral') then 'invalid_sentiment'
    when try_cast(json_extract_string(body, '$.confidence') as double) is null then 'invalid_confidence'
  end as reject_reason from fx_bodies) b""",
        ("fx_bodies",),
    ),
    "fx_enriched": ("select * from fx_parsed where reject_reason is null", ("fx_parsed",)),
    "fx_staged_news": (
        """
select n.article_id, n.title, n.description, n.source_name, n.published_at, n.ingested_at, e.sentiment,
  e.confidence, e.ticker, e.topic, e.market_implication
from fx_bronze_news n join fx_enriched e on n.article_id = e.article_id where e.confidence > 0""",
        ("fx_bronze_news", "fx_enriched"),
    ),
    "fx_gate_results": (
        """
select concat(cast(event_id as varchar), '-g') as record_id,
  case when user_id % 3 = 0 then 'stocks' when user_id % 3 = 1 then 'news' else 'macro' end as source,
  ts as checked_at, event_id % (5 + cast(day(ts) as int) % 4) <> 0 as passed,
  case when event_id % (5 + cast(day(ts) as int) % 4) <> 0 then null
       else list_extract(list_value('SCHEMA_MISSING_FIELD','SCHEMA_WRONG_TYPE','RANGE_VIOLATION','STALE','DUPLICATE'),
         cast(event_id % 5 as int) + 1) end as failure_code
from events""",
        (),
    ),
    "fx_trust": (
        """
select cast(checked_at as date) as date, source, count(*) as records_checked,
  cast(sum(case when passed then 1 else 0 end) as bigint) as records_passed,
  cast(sum(case when passed then 0 else 1 end) as bigint) as records_failed,
  round(sum(case when passed then 1 else 0 end)::double / count(*), 8) as pass_rate,
  round(1.0::double - sum(case failure_code when 'SCHEMA_MISSING_FIELD' then 2.0::double
      when 'SCHEMA_WRONG_TYPE' then 2.0::double when 'RANGE_VIOLATION' then 1.5::double
      when 'STALE' then 1.0::double when 'DUPLICATE' then 0.5::double else 0.0::double end)
    / (count(*) * 2.0::double), 8) as trust_score,
  round(sum(case when passed then 1 else 0 end)::double / count(*), 4) < 0.85 as is_blocked
from fx_gate_results group by 1, 2""",
        ("fx_gate_results",),
    ),
    "fx_macro": (
        """
select o_orderpriority as series_id, cast(o_orderdate as date) as date,
  case when o_orderkey % 20 = 0 then null else o_totalprice end as value, o_orderdate as ingested_at, o_orderkey as k
from orders""",
        (),
    ),
    "fx_posts": (
        """
select concat(cast(conv_id as varchar), '_', cast(turn as varchar)) as post_id, role as subreddit,
  split_part(text, chr(10), 1) as title, cast(case when turn % 5 = 0 then 0 else length(text) end as int) as score,
  cast(turn as int) as num_comments, timestamp '2024-01-01 00:00:00' + conv_id * interval 1 hour as created_utc,
  substr(text, 1, 500) as body_snippet
from conversations where turn <> 0""",
        (),
    ),
    "fx_ticks": (
        """
select cast(event_id as varchar) as event_id, event_type as ticker, ts as bar_timestamp,
  value as open, value + 1.0 as high, value - 0.25 as low, value + (event_id % 5) * 0.25 as close,
  cast(json_extract_string(props, '$.k') as bigint) - 5 as volume, ts + (event_id % 30) * interval 1 minute as as_of
from events""",
        (),
    ),
    "fx_gated_ticks": (
        """
select *, case
    when ticker is null or bar_timestamp is null or open is null or volume is null then 'SCHEMA_MISSING_FIELD'
    when open <= 0 or high <= 0 or low <= 0 or close <= 0 or volume < 0 or high < low
      or abs((close - open) / open) * 100 > 20 then 'RANGE_VIOLATION'
    when bar_timestamp < as_of - interval 20 minute or bar_timestamp > as_of + interval 2 minute then 'STALE'
  end as failure_code
from fx_ticks""",
        ("fx_ticks",),
    ),
    "fx_staged_bars": (
        """
select ticker, date, open, high, low, close, volume, round(high - low, 8) as price_range,
  round((close - open) / nullif(open, 0) * 100, 8) as intraday_pct_change
from fx_bars where close > 0 and volume >= 0 and high >= low""",
        ("fx_bars",),
    ),
    "fx_history": (
        """
select ticker, max(case when r = 1 then date end) as date, max(case when r = 1 then close end) as close,
  count(case when r > 1 then close end) as n_history, avg(case when r > 1 then close end) as avg_close,
  stddev_pop(case when r > 1 then close end) as std_close
from (select *, row_number() over (partition by ticker order by date desc) as r from fx_bars) b group by ticker""",
        ("fx_bars",),
    ),
    "fx_anomalies": (
        """
select *, (close - avg_close) / avg_close * 100 as pct_change, abs(close - avg_close) / std_close as std_devs,
  case when close > avg_close then 'UP' else 'DOWN' end as direction
from fx_history where n_history >= 5 and std_close <> 0 and abs(close - avg_close) / std_close >= 2.0""",
        ("fx_history",),
    ),
    "fx_daily_bars": (
        """
select s.*, round(avg(s.close) over w7, 8) as avg_close_7d, round(avg(s.close) over w30, 8) as avg_close_30d,
  a.ticker is not null as is_anomaly,
  case when a.ticker is not null then concat('move of ', s.ticker) end as anomaly_explanation
from fx_staged_bars s left join fx_anomalies a on s.ticker = a.ticker and s.date = a.date
window w7 as (partition by s.ticker order by s.date rows between 6 preceding and current row),
  w30 as (partition by s.ticker order by s.date rows between 29 preceding and current row)""",
        ("fx_staged_bars", "fx_anomalies"),
    ),
    "fx_daily_sentiment": (
        """
select cast(published_at as date) as date, count(*) as article_count, round(avg(confidence), 8) as avg_confidence,
  round(sum(case when sentiment = 'bullish' then confidence else 0 end) / nullif(sum(confidence), 0), 8)
    as bullish_score,
  round(sum(case when sentiment = 'bearish' then confidence else 0 end) / nullif(sum(confidence), 0), 8)
    as bearish_score,
  round(sum(case when sentiment = 'neutral' then confidence else 0 end) / nullif(sum(confidence), 0), 8)
    as neutral_score,
  case when round(sum(case when sentiment = 'bullish' then confidence else 0 end), 8)
          > round(sum(case when sentiment = 'bearish' then confidence else 0 end), 8) then 'bullish'
       when round(sum(case when sentiment = 'bearish' then confidence else 0 end), 8)
          > round(sum(case when sentiment = 'bullish' then confidence else 0 end), 8) then 'bearish'
       else 'neutral' end as dominant_sentiment
from fx_staged_news group by 1""",
        ("fx_staged_news",),
    ),
    "fx_latest_trust": (
        """
select source, max(date) as date, arg_max(trust_score, date) as trust_score, arg_max(is_blocked, date) as is_blocked
from fx_trust group by source""",
        ("fx_trust",),
    ),
    "fx_mart": (
        """
select b.*, round((b.close - b.avg_close_30d) / nullif(b.avg_close_30d, 0) * 100, 8) as pct_from_30d_avg,
  n.dominant_sentiment as market_sentiment, n.bullish_score, n.bearish_score, n.article_count,
  n.avg_confidence as sentiment_confidence, ts.trust_score as stocks_trust_score, ts.is_blocked as stocks_blocked,
  tn.trust_score as news_trust_score, tn.is_blocked as news_blocked,
  not (coalesce(ts.is_blocked, false) or coalesce(tn.is_blocked, false)) as advisor_can_serve
from fx_daily_bars b left join fx_daily_sentiment n on b.date = n.date
left join (select * from fx_latest_trust where source = 'stocks') ts on true
left join (select * from fx_latest_trust where source = 'news') tn on true""",
        ("fx_daily_bars", "fx_daily_sentiment", "fx_latest_trust"),
    ),
    "fx_status": (
        """
select bool_and(advisor_can_serve) as can_serve, max(stocks_trust_score) as stocks_trust,
  max(news_trust_score) as news_trust, bool_or(stocks_blocked) as stocks_blocked,
  bool_or(news_blocked) as news_blocked, max(date) as data_date
from fx_mart""",
        ("fx_mart",),
    ),
    "fx_links": (
        """
select page_id, pos, release_id, title, concat('https://example.org/', release_id) as url
from (select page_id, pos, regexp_extract(regexp_extract(anchor,
          '(?is)^<a\\s[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), '^/(.+)$', 1) as release_id,
        replace(replace(replace(replace(replace(replace(
          trim(regexp_replace(anchor, '\\s*<[^>]*>\\s*', '', 'g'), chr(32) || chr(9) || chr(10) || chr(13)),
          '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&') as title
      from (select page_id, unnest(range(len(anchors))) as pos, unnest(anchors) as anchor
            from (select page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*>.*?</a>') as anchors from pages) p) a) l
where release_id <> ''""",
        (),
    ),
}


def oracle(text: str, *views: str) -> str:
    """``text`` with the views it reads, and theirs, as common table expressions."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for inner in SQL[name][1]:
            need(inner)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        need(view)
    if not ordered:
        return text.strip()
    ctes = ",\n".join(f"{name} as ({SQL[name][0].strip()})" for name in ordered)
    return f"with {ctes}\n{text.strip()}"
