"""Snapshots, named sources, normalisation and link extraction."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from sieveline import schemas
from sieveline.functions import normalize as N, text as X
from sieveline.operators import dedupe
from sieveline.plans import staging
from sieveline.session import scratch_dir
from sieveline.sources import snapshots, tables
from workload.fixtures import Inputs
from workload.gate_queries import links
from workload.registry import query

_NORMAL = """
select ticker, replace(ticker, '.NS', '') as ticker_clean, cast(date as varchar) as date, round(open, 2) as open,
  round(high, 2) as high, round(low, 2) as low, round(close, 2) as close, volume, 'yfinance' as source,
  'NSE' as exchange
from fx_bars"""


@query("normalize_bars", _NORMAL, ("fx_bars",))
def normalize_bars(fx: Inputs) -> DataFrame:
    return N.normalize_bars(fx.bars)


def _snapshot(fx: Inputs) -> str:
    """Normalised bars as dated JSON snapshots; returns the zone."""
    zone = scratch_dir(fx.spark, "zone")
    snapshots.write_snapshot(N.normalize_bars(fx.bars), zone, "bars", day_column="date")
    return zone


def _snapshot_rows(df: DataFrame) -> DataFrame:
    prices = [F.col(p).cast("double").alias(p) for p in N.PRICES]
    return df.select("ticker", "date", *prices, F.col("volume").cast("bigint").alias("volume"), "source", "feed", "day")


_SNAPSHOT = """
select ticker, cast(date as varchar) as date, round(open, 2) as open, round(high, 2) as high, round(low, 2) as low,
  round(close, 2) as close, volume, 'yfinance' as source, 'bars' as feed, date as day
from fx_bars"""


@query("read_json_snapshot", _SNAPSHOT, ("fx_bars",))
def read_json_snapshot(fx: Inputs) -> DataFrame:
    return _snapshot_rows(snapshots.read_snapshot(fx.spark, _snapshot(fx), schemas.RAW["stocks"]))


@query(
    "write_snapshot",
    """
select ticker, cast(date as varchar) as date, round(open, 2) as open, round(high, 2) as high, round(low, 2) as low,
  round(case when date = date '2024-01-02' then close + 1 else close end, 2) as close, volume, 'yfinance' as source,
  'bars' as feed, date as day
from fx_bars""",
    ("fx_bars",),
)
def write_snapshot(fx: Inputs) -> DataFrame:
    """All days, then one day again: only that day is replaced."""
    zone = _snapshot(fx)
    again = fx.bars.filter(F.col("date") == date(2024, 1, 2)).withColumn("close", F.col("close") + 1)
    snapshots.write_snapshot(N.normalize_bars(again), zone, "bars", day="2024-01-02")
    return _snapshot_rows(snapshots.read_snapshot(fx.spark, zone, schemas.RAW["stocks"]))


@query("read_json_array", _SNAPSHOT.replace("'bars' as feed, date as day", "'NSE' as exchange"), ("fx_bars",))
def read_json_array(fx: Inputs) -> DataFrame:
    """Each day's records as JSON arrays, each in a file of its own."""
    zone = scratch_dir(fx.spark, "arrays")
    snapshots.write_json_arrays(N.normalize_bars(fx.bars), zone, "date")
    rows = snapshots.read_json_array(fx.spark, f"{zone}/*", schemas.RAW["stocks"])
    prices = [F.col(p).cast("double").alias(p) for p in N.PRICES]
    return rows.select("ticker", "date", *prices, F.col("volume").cast("bigint").alias("volume"), "source", "exchange")


@query("partition_scan", _SNAPSHOT + " where date = date '2024-01-03'", ("fx_bars",))
def partition_scan(fx: Inputs) -> DataFrame:
    return _snapshot_rows(
        snapshots.read_snapshot(fx.spark, _snapshot(fx), schemas.RAW["stocks"], source="bars", day="2024-01-03")
    )


@query(
    "file_lineage",
    """
select concat('feed=bars/day=', cast(date as varchar)) as directory, count(*) as n_records
from fx_bars group by date""",
    ("fx_bars",),
)
def file_lineage(fx: Inputs) -> DataFrame:
    files = snapshots.file_lineage(fx.spark, _snapshot(fx), schemas.RAW["stocks"], "*.json")
    return files.groupBy("directory").agg(F.sum("n_records").alias("n_records"))


_SOURCES = ("customer", "documents", "events", "labels", "lineitem", "orders", "pages")


@query(
    "source_scan",
    " union all ".join(f"select '{s}' as source, count(*) as n_rows from {s}" for s in _SOURCES)
    + " union all select 'stock_anomalies', 0",
)
def source_scan(fx: Inputs) -> DataFrame:
    """Rows of every declared source; a declared table not stored yet is empty."""
    declared = {s: fx.path(s) for s in _SOURCES} | {"stock_anomalies": f"{fx.sf_dir}/absent/stock_anomalies"}
    sources = tables.Sources(fx.spark, declared)
    counts = [
        sources.scan(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name in sources.names()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


@query(
    "lookback_window",
    "select ticker, date, close from fx_bars where date >= date '2024-01-10' and date < date '2024-01-15'",
    ("fx_bars",),
)
def lookback_window(fx: Inputs) -> DataFrame:
    return N.lookback(fx.bars, F.lit(date(2024, 1, 15))).select("ticker", "date", "close")


_TERMS = ("the", "with", "thing", "blest")


@query(
    "recent_matching_docs",
    """
select article_id, published_at, title, source_name from fx_bronze_news
where lang = 'en' and published_at >= timestamp '2024-01-30 00:00:00' - interval 47 hour
  and regexp_matches(description, '(?i)\\b(the|with|thing|blest)\\b')
order by published_at desc, article_id limit 50""",
    ("fx_bronze_news",),
)
def recent_matching_docs(fx: Inputs) -> DataFrame:
    since = F.to_timestamp(F.lit("2024-01-30 00:00:00")) - F.make_dt_interval(hours=F.lit(47))
    found = N.recent_matching(fx.bronze_news, since, _TERMS, text="description")
    return found.select("article_id", "published_at", "title", "source_name")


@query(
    "recent_matching_cut",
    """
select article_id, published_at from fx_bronze_news
where lang = 'en' and published_at >= timestamp '2024-01-05 00:00:00'
  and regexp_matches(description, '(?i)\\b(the|with|thing|blest)\\b')
order by published_at desc, article_id limit 7""",
    ("fx_bronze_news",),
)
def recent_matching_cut(fx: Inputs) -> DataFrame:
    """Many articles share the newest times: the limit cuts among equals, by identifier."""
    since = F.to_timestamp(F.lit("2024-01-05 00:00:00"))
    return N.recent_matching(fx.bronze_news, since, _TERMS, text="description", n=7).select("article_id", "published_at")


@query(
    "channels_side_by_side",
    """
select 'stored' as kind, role as name, count(*) as n, cast(null as varchar) as status from conversations group by role
union all select 'log', role, count(*), 'success' from conversations group by role
union all select 'log', 'broken', 0, 'failed' union all select 'log', 'absent', 0, 'failed'""",
)
def channels_side_by_side(fx: Inputs) -> DataFrame:
    """A job for each role; one channel breaks while it runs, one is not there, the others are stored."""
    turns, path = fx.table("conversations"), scratch_dir(fx.spark, "channels")
    roles = [r.role for r in turns.select("role").distinct().collect()]
    broken = F.when(F.col("turn") < 0, F.col("text")).otherwise(F.raise_error(F.lit("connection lost")))
    channels = {name: (lambda name=name: turns.where(F.col("role") == name).drop("role")) for name in roles}
    channels |= {"broken": lambda: turns.withColumn("text", broken), "absent": lambda: fx.table("no_such_table")}
    log = tables.store_channels(fx.spark, channels, path, "1")
    stored = tables.stored_channels(fx.spark, path, "1", "name").groupBy("name").agg(F.count("*").alias("n"))
    stored = stored.select(F.lit("stored").alias("kind"), "name", "n", F.lit(None).cast("string").alias("status"))
    return stored.union(log.select(F.lit("log"), "source", "records", "status"))


@query(
    "run_log",
    """
select 'bars' as source, count(*) as records, 'success' as status, cast(null as varchar) as error from fx_bars
union all
select 'links', count(*), 'success', case when count(*) = 0 then 'nothing matched' end
from fx_links where title like '%repo rate%'
union all
select 'absent', 0, 'failed', 'AnalysisException'""",
    ("fx_bars", "fx_links"),
)
def run_log(fx: Inputs) -> DataFrame:
    """A run that writes, one that finds nothing, one that fails."""
    root = scratch_dir(fx.spark, "runs")
    loads = {
        "bars": lambda: fx.bars,
        "links": lambda: links(fx).filter(F.col("title").contains("repo rate")),
        "absent": lambda: fx.table("no_such_table"),
    }
    log = [
        tables.logged_run(
            fx.spark, f"run-{name}", name, load, lambda df, to=f"{root}/{name}": df.write.parquet(to), "nothing matched"
        )
        for name, load in loads.items()
    ]
    out = log[0]
    for row in log[1:]:
        out = out.unionByName(row)
    return out.select("source", "records", "status", F.split_part("error", F.lit(":"), F.lit(1)).alias("error"))


@query("symbol_clean", "select distinct ticker, replace(ticker || '.NS', '.NS', '') as clean from fx_bars", ("fx_bars",))
def symbol_clean(fx: Inputs) -> DataFrame:
    listed = fx.bars.select("ticker", F.concat("ticker", F.lit(".NS")).alias("listed")).distinct()
    return listed.select("ticker", X.symbol_clean(F.col("listed")).alias("clean"))


@query(
    "latest_per_key",
    """
select ticker, date, close, volume from fx_bars
qualify row_number() over (partition by ticker order by date desc) = 1""",
    ("fx_bars",),
)
def latest_per_key(fx: Inputs) -> DataFrame:
    return dedupe.latest_per_key(fx.bars, ["ticker"], ["date"]).select("ticker", "date", "close", "volume")


@query(
    "normalize_articles",
    """
select article_id, title, description, url, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as published_at, source_name
from fx_bronze_news""",
    ("fx_bronze_news",),
)
def normalize_articles(fx: Inputs) -> DataFrame:
    received = fx.bronze_news.select(
        "title", "description", "url",
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.struct(F.col("source_name").alias("name")).alias("source"),
    )
    return N.normalize_articles(received)


@query("url_hash_id", "select page_id, url, md5(url) as article_id from pages")
def url_hash_id(fx: Inputs) -> DataFrame:
    return fx.table("pages").select("page_id", "url", N.url_hash_id(F.col("url")).alias("article_id"))


@query("extract_links", "select page_id, pos, release_id, title, url from fx_links", ("fx_links",))
def extract_links(fx: Inputs) -> DataFrame:
    return links(fx).select("page_id", F.col("pos").cast("bigint").alias("pos"), "release_id", "title", "url")


_WORDS = ("nicht", "tion", "the", "ing", "eau")


@query(
    "keyword_filter",
    "select page_id, pos, title from fx_links where "
    + " or ".join(f"contains(lower(title), '{w}')" for w in _WORDS),
    ("fx_links",),
)
def keyword_filter(fx: Inputs) -> DataFrame:
    found = links(fx).filter(N.mentions_keyword(F.col("title"), _WORDS))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "title")


@query("min_length_filter", "select page_id, pos, title from fx_links where length(title) >= 10", ("fx_links",))
def min_length_filter(fx: Inputs) -> DataFrame:
    found = links(fx).filter(N.long_enough(F.col("title")))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "title")


@query(
    "dedupe_first",
    """
select release_id, title, page_id, pos from fx_links
qualify row_number() over (partition by release_id order by page_id, pos) = 1""",
    ("fx_links",),
)
def dedupe_first(fx: Inputs) -> DataFrame:
    first = dedupe.dedupe_first(links(fx), ["release_id"], ["page_id", "pos"])
    return first.select("release_id", "title", "page_id", F.col("pos").cast("bigint").alias("pos"))


_POSTS = "select post_id, subreddit, title, score, num_comments, created_utc, body_snippet from fx_posts"


@query("normalize_posts", _POSTS, ("fx_posts",))
def normalize_posts(fx: Inputs) -> DataFrame:
    return N.normalize_posts(fx.listings, F.col("channel")).drop("upvote_ratio")


@query(
    "union_channels",
    "select subreddit as channel, post_id, title, score from fx_posts",
    ("fx_posts",),
)
def union_channels(fx: Inputs) -> DataFrame:
    """Every channel of the table, and one that cannot be read."""

    def channel(name: str):
        return lambda: N.normalize_posts(fx.listings.filter(F.col("channel") == name), F.lit(name))

    loads = {name: channel(name) for name in ("user", "assistant", "system")}
    loads["absent"] = lambda: fx.table("no_such_channel")
    return N.union_channels(loads).select("channel", "post_id", "title", "score")


@query(
    "staged_bars",
    "select ticker, date, open, high, low, close, volume, price_range, intraday_pct_change from fx_staged_bars",
    ("fx_staged_bars",),
)
def staged_bars(fx: Inputs) -> DataFrame:
    return stage_bars(fx).drop("_loaded_at", "ingested_at")


def stage_bars(fx: Inputs) -> DataFrame:
    return staging.staged_bars(fx.bars.withColumn("ingested_at", F.col("date")), price_scale=8, pct_scale=8)


@query(
    "staged_macro",
    "select series_id, date, value, ingested_at from fx_macro where value is not null",
    ("fx_macro",),
)
def staged_macro(fx: Inputs) -> DataFrame:
    return staging.staged_macro(fx.macro).drop("_loaded_at")
