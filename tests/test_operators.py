"""Windows, anomalies, dedupe, models and checks against brute force."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sieveline import config as C
from sieveline.functions import calendar, normalize as N, text as X
from sieveline.operators import anomaly as A, checks, dedupe as D, rolling
from sieveline.plans import intermediate as I, mart as M, staging


def bars_of(spark, seed=1, symbols=6, days=120):
    rng = random.Random(seed)
    data = []
    for s in range(symbols):
        day = date(2024, 1, 1)
        # The first symbol holds a third of all rows; others have gaps.
        for i in range(days if s == 0 else days * 2 // (symbols - 1)):
            day += timedelta(days=1 if s == 0 else rng.choice([1, 1, 3, 20]))
            data.append((f"T{s}", day, round(rng.uniform(5, 20), 2) if rng.random() > 0.05 else None))
    return data, spark.createDataFrame(data, "ticker string, date date, close double")


@pytest.mark.parametrize("bucket, most", [("week", 0), ("month", 0), ("year", 0), ("size", 1), ("size", 25), ("size", 100), ("size", 10_000)])
def test_trailing_averages_equal_the_single_window(spark, bucket, most):
    data, df = bars_of(spark)
    got = {
        (r.ticker, r.date): (r.a7, r.a30)
        for r in rolling.trailing_averages(df, {"a7": 7, "a30": 30}, bucket=bucket, most_rows=most).collect()
    }
    assert len(got) == len(data)
    by = {}
    for ticker, day, close in sorted(data, key=lambda r: (r[0], r[1])):
        history = by.setdefault(ticker, [])
        history.append(close)
        for have, size in zip(got[(ticker, day)], (7, 30)):
            values = [c for c in history[-size:] if c is not None]
            if values:
                assert have == pytest.approx(sum(values) / len(values), rel=1e-12)
            else:
                assert have is None


def test_trailing_average_of_one_row_is_the_value(spark):
    _, df = bars_of(spark)
    wrong = rolling.trailing_averages(df, {"a": 1}).filter(~F.col("a").eqNullSafe(F.col("close")))
    assert wrong.count() == 0


@pytest.mark.parametrize("bucket", ["week", "month", "year"])
def test_latest_vs_history(spark, bucket):
    data, df = bars_of(spark, seed=2)
    got = {r.ticker: r for r in A.latest_vs_history(df, bucket=bucket).collect()}
    for ticker in {r[0] for r in data}:
        rows = sorted((d, c) for t, d, c in data if t == ticker and c is not None)
        history = np.array([c for _, c in rows[:-1]])
        row = got[ticker]
        assert (row.date, row.close, row.n_history) == (rows[-1][0], rows[-1][1], len(history))
        assert row.avg_close == pytest.approx(history.mean(), rel=1e-12)
        assert row.std_close == pytest.approx(history.std(), rel=1e-9)


def series(rows, closes, ticker="T"):
    start = date(2024, 1, 25)
    return rows([(ticker, start + timedelta(days=i), c) for i, c in enumerate(closes)], "ticker string, date date, close double")


@pytest.mark.parametrize(
    "closes, found",
    [
        ([9.0, 11.0, 9.0, 11.0, 9.0, 11.0, 12.0], 1),  # mean 10, deviation 1: exactly 2
        ([9.0, 11.0, 9.0, 11.0, 9.0, 11.0, 11.9], 0),
        ([9.0, 11.0, 9.0, 11.0, 100.0], 0),  # four earlier rows
        ([9.0, 11.0, 9.0, 11.0, 9.0, 100.0], 1),  # five earlier rows
        ([0.1] * 9 + [100.0], 0),  # no spread, though its mean is not exactly 0.1
    ],
)
@pytest.mark.parametrize("bucket", ["week", "month"])
def test_anomaly_limits(rows, closes, found, bucket):
    stats = A.latest_vs_history(series(rows, closes), bucket=bucket)
    assert A.price_anomalies(stats).count() == found


def test_recorded_anomalies_are_left_out(rows):
    found = A.price_anomalies(A.latest_vs_history(series(rows, [9.0, 11.0, 9.0, 11.0, 9.0, 3.0])))
    row = found.first()
    assert row.direction == "DOWN" and row.pct_change < 0
    recorded = rows([("T", str(row.date))], "ticker string, date string")
    assert A.new_anomalies(found, recorded).count() == 0
    assert A.new_anomalies(found, recorded.filter("ticker = 'other'")).count() == 1


NEWS = "article_id string, title string, sentiment string, confidence double, tickers_mentioned array<string>"


def test_headline_context(rows):
    news = rows(
        [
            ("1", "one", "bullish", 0.9, ["A", "A"]),
            ("2", "two", "bearish", 0.5, ["A", "B"]),
            ("3", "three", "neutral", 0.95, ["A"]),
            ("4", "four", "bullish", 0.6, ["A"]),
            ("5", "five", "bearish", 0.49, ["B"]),
        ],
        NEWS,
    )
    found = rows([("A", 1.0), ("C", 1.0)], "ticker string, close double")
    got = {r.ticker: r.news_context for r in A.headline_context(found, news).collect()}
    assert got["A"] == "- [NEUTRAL 95%] three\n- [BULLISH 90%] one\n- [BULLISH 60%] four"
    assert got["C"] == X.MARKET_WIDE_PREFIX + "- [BULLISH 90%] one"
    quiet = A.headline_context(found, news.filter("confidence < 0.5"))
    assert {r.news_context for r in quiet.collect()} == {""}


def test_dedupe_keeps_the_right_row(rows):
    log = rows([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, seq int, v string")
    assert {tuple(r) for r in D.upsert_latest(log, ["k"], ["seq"]).collect()} == {("a", 2, "y"), ("b", 5, "z")}
    assert {tuple(r) for r in D.dedupe_first(log, ["k"], ["seq"]).collect()} == {("a", 1, "x"), ("b", 5, "z")}


def test_trust_and_breaker(rows):
    def day(passed, failed, code="STALE"):
        return [("s", datetime(2024, 1, 1, 23, 59), True, None)] * passed + [
            ("s", datetime(2024, 1, 1), False, code)
        ] * failed

    schema = "source string, checked_at timestamp, passed boolean, failure_code string"
    row = I.trust_scores(rows(day(17, 3), schema)).first()
    assert (row.records_checked, row.pass_rate, row.trust_score, row.is_blocked) == (20, 0.85, 0.925, False)
    row = I.trust_scores(rows(day(84, 16, "SCHEMA_WRONG_TYPE"), schema)).first()
    assert (row.pass_rate, row.trust_score, row.is_blocked) == (0.84, 0.84, True)
    # By trust score the same day of mild failures would be served.
    mild = rows(day(84, 16, "DUPLICATE"), schema)
    assert I.trust_scores(mild).first().is_blocked
    assert not I.trust_scores(mild, breaker_metric="trust_score").first().is_blocked


def test_source_status_is_the_newest_day(rows):
    schema = "date date, source string, pass_rate double, trust_score double, is_blocked boolean"
    data = [
        (date(2024, 1, 1), "news", 0.9, 0.95, False), (date(2024, 1, 2), "news", 0.8, 0.9, True),
        (date(2024, 1, 1), "macro", 1.0, 1.0, False),
    ]
    got = {r.source: (r.trust_score, r.is_blocked, r.block_reason) for r in M.source_status(rows(data, schema)).collect()}
    assert got == {"news": (0.9, True, "pass rate 80.00% below the limit"), "macro": (1.0, False, None)}


def test_sentiment_tie_is_neutral(rows):
    schema = "published_at timestamp, sentiment string, confidence double"
    at = datetime(2024, 1, 1, 12)
    data = [(at, "bullish", 0.1), (at, "bullish", 0.2), (at, "bearish", 0.3), (at, "neutral", 0.9), (at, "bearish", 0.0)]
    row = I.daily_sentiment(rows(data, schema)).first()
    assert row.dominant_sentiment == "neutral" and row.article_count == 4
    assert row.neutral_score == pytest.approx(0.6)


def test_mart_without_trust_is_served(rows):
    bars = rows([("A", date(2024, 1, 1), 10.0, 0.0)], "ticker string, date date, close double, avg_close_30d double")
    for c in ("open", "high", "low", "volume", "price_range", "intraday_pct_change", "avg_close_7d"):
        bars = bars.withColumn(c, F.lit(1.0))
    bars = bars.withColumns({"is_anomaly": F.lit(False), "anomaly_explanation": F.lit(None).cast("string")})
    sentiment = rows([], "date date, dominant_sentiment string, bullish_score double, bearish_score double, article_count bigint, avg_confidence double")
    trust = rows([], "date date, source string, trust_score double, is_blocked boolean")
    row = M.symbol_mart(bars, sentiment, trust).first()
    assert row.advisor_can_serve and row.stocks_trust_score is None and row.pct_from_30d_avg is None
    assert not M.symbol_mart(bars, sentiment, trust, fail_closed=True).first().advisor_can_serve
    trust = rows(
        [(date(2024, 1, 1), "news", 0.9, False), (date(2024, 1, 2), "news", 0.5, True)],
        "date date, source string, trust_score double, is_blocked boolean",
    )
    row = M.symbol_mart(bars, sentiment, trust).first()
    assert (row.news_trust_score, row.news_blocked, row.advisor_can_serve) == (0.5, True, False)


def test_staged_bars_drop_implausible_rows(rows):
    schema = "ticker string, date date, open double, high double, low double, close double, volume bigint, ingested_at timestamp"
    day = date(2024, 1, 1)
    data = [
        ("ok", day, 10.0, 12.0, 9.0, 11.0, 0, None), ("zero", day, 10.0, 12.0, 9.0, 0.0, 1, None),
        ("neg", day, 10.0, 12.0, 9.0, 11.0, -1, None), ("inv", day, 10.0, 8.0, 9.0, 11.0, 1, None),
        ("open0", day, 0.0, 12.0, 9.0, 11.0, 1, None),
    ]
    got = {r.ticker: r.intraday_pct_change for r in staging.staged_bars(rows(data, schema)).collect()}
    assert got == {"ok": 10.0, "open0": None}


def test_checks(rows):
    df = rows([("a", 1), ("a", 2), (None, 3), ("b", None), (None, 4)], "k string, v int")
    got = {(r.column_name, r.test): r.failures for r in checks.not_null(df, "m", ["k", "v"]).collect()}
    assert got == {("k", "not_null"): 2, ("v", "not_null"): 1}
    assert checks.unique(df, "m", "k").first().failures == 1
    assert checks.accepted_values(df, "m", "k", ["a"]).first().failures == 1


@pytest.mark.parametrize(
    "utc, inside, wait",
    [
        ("2024-01-01 03:45:00", True, 86400),  # Monday 09:15, open: wait for tomorrow's
        ("2024-01-01 03:44:59", False, 1),
        ("2024-01-01 10:00:00.9", True, 63899),  # 15:30:00, the last second
        ("2024-01-01 10:00:01", False, 63899),
        ("2024-01-05 10:30:00", False, 234900),  # Friday evening to Monday
        ("2024-01-06 05:00:00", False, 168300),  # Saturday
        ("2024-01-07 00:00:00", False, 99900),  # Sunday
    ],
)
def test_session_calendar(spark, utc, inside, wait):
    ts = F.lit(utc).cast("timestamp")
    row = spark.range(1).select(
        calendar.in_session(ts).alias("inside"), calendar.seconds_until_open(ts).alias("wait")
    ).first()
    assert (row.inside, row.wait) == (inside, wait)


def test_links_from_html(rows):
    html = (
        '<A class=x HREF="?prid=12"> <b>Repo rate</b> &amp; CPI\n held </A><a href="/other">no id here</a>'
        "<a href='?prid=13'>short</a><a href=\"?prid=12\">Repo rate repeated</a><p>prid=99</p>"
    )
    links = N.extract_links(rows([(1, html)], "page_id int, html string"))
    got = [(r.pos, r.release_id, r.title) for r in links.orderBy("pos").collect()]
    assert got == [(0, "12", "Repo rate& CPI\n held"), (2, "13", "short"), (3, "12", "Repo rate repeated")]
    kept = links.filter(N.long_enough(F.col("title")) & N.mentions_keyword(F.col("title")))
    first = D.dedupe_first(kept, ["release_id"], ["page_id", "pos"]).collect()
    assert [(r.release_id, r.pos) for r in first] == [("12", 0)]
    assert first[0].url.endswith("prid=12")
    pages = rows([(1, html), (0, html)], "page_id int, html string")
    release = N.press_releases(pages, F.lit("2024-01-01T00:00:00Z")).collect()
    assert [(r.release_id, r.title, r.scraped_at) for r in release] == [("12", "Repo rate& CPI\n held", "2024-01-01T00:00:00Z")]


def test_posts(spark):
    schema = (
        "data struct<children:array<struct<data:struct<id:string,title:string,score:int,num_comments:int,"
        "upvote_ratio:double,created_utc:bigint,selftext:string,stickied:boolean>>>>"
    )
    post = lambda *v: {"data": dict(zip(("id", "title", "score", "num_comments", "upvote_ratio", "created_utc", "selftext", "stickied"), v))}
    page = {"children": [post("1", "t", None, None, 0.5, None, None, None), post("2", "t", 3, 4, 0.5, 60, "x" * 600, False), post("3", "rules", 1, 1, 1.0, 1, "", True)]}
    got = N.normalize_posts(spark.createDataFrame([(page,)], schema), F.lit("c")).orderBy("post_id").collect()
    assert [r.post_id for r in got] == ["1", "2"]
    assert (got[0].score, got[0].num_comments, got[0].body_snippet) == (0, 0, "")
    assert got[0].created_utc == datetime(1970, 1, 1) and len(got[1].body_snippet) == 500


def test_number_texts(spark):
    row = spark.range(1).select(
        X.signed_pct(F.lit(1.005)).alias("a"), X.signed_pct(F.lit(-0.5)).alias("b"), X.whole_pct(F.lit(0.875)).alias("c"),
        X.fixed(F.lit(95.0), 1).alias("d"), X.strip_quotes(F.lit("\"'It fell.'\"")).alias("e"),
    ).first()
    assert tuple(row) == ("+1.01%", "-0.50%", "88%", "95.0", "It fell.")


def test_values_that_are_no_numbers_reach_the_gate_as_nulls(rows):
    schema = "ticker string, date date, open string, high string, low string, close string, volume string"
    row = N.normalize_bars(rows([("A.NS", date(2024, 1, 1), "1.005", "2", "x", "1", "many")], schema)).first()
    assert (row.ticker_clean, row.date, row.low, row.volume) == ("A", "2024-01-01", None, None)


def test_odd_numbers_do_not_stop_rendering(spark):
    row = spark.range(1).select(X.signed_pct(F.lit(float("nan"))).alias("a"), X.fixed(F.lit(float("inf")), 2).alias("b")).first()
    assert tuple(row) == (None, None)


def test_lookback_is_half_open(rows):
    df = rows([(date(2024, 1, d),) for d in (9, 10, 14, 15)], "date date")
    got = [r.date.day for r in N.lookback(df, F.lit(date(2024, 1, 15))).collect()]
    assert sorted(got) == [10, 14]


def test_weights_are_the_declared_ones():
    assert C.SEVERITY == {
        "SCHEMA_MISSING_FIELD": 2.0, "SCHEMA_WRONG_TYPE": 2.0, "RANGE_VIOLATION": 1.5, "STALE": 1.0, "DUPLICATE": 0.5
    }


def test_history_is_not_sorted_by_bars_and_merges_from_states(spark, rows):
    """No window over bars; states of days stored one after the other give the same as all bars at once."""
    from sieveline.session import scratch_dir

    bars = series(rows, [9.0, 11.0, 9.5, 11.0, 9.0, 3.0, 8.0])
    whole = A.latest_vs_history(bars, bucket="week")
    plan = plan_of(whole)
    assert "row_number" not in plan and "RowNumber" not in plan
    path = scratch_dir(spark, "states")
    days = [r[0] for r in bars.select("date").distinct().orderBy("date").collect()]
    for day in [*days, days[2]]:
        A.store_states(bars.where(F.col("date") == F.lit(day)), path)
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    got = A.latest_from_states(spark.read.parquet(path))
    assert sorted(map(key, got.collect())) == sorted(map(key, whole.collect()))


def test_headlines_of_the_asked_symbols_only(rows):
    news = rows([("1", "a", "bullish", 0.9, ["X", "Y"]), ("2", "b", "bearish", 0.8, ["Z"])], "article_id string, title string, sentiment string, confidence double, tickers_mentioned array<string>")
    asked = A.symbol_headlines(news, symbols=rows([("X",), ("X",)], "ticker string"))
    assert [(r.ticker, r.article_id) for r in asked.collect()] == [("X", "1")]


def test_only_heavy_symbols_are_cut_and_their_parts_are_even(spark):
    """Daily bars and ticks alike: no task holds much more than it may, whatever the time unit."""
    ticks = spark.range(20_000).select(F.lit("busy").alias("ticker"), F.timestamp_micros(F.col("id") * 1000 + F.pow(F.col("id") % 997, F.lit(4)).cast("long")).alias("at"), F.rand(3).alias("close"))
    daily = spark.range(400).select(F.lit("plain").alias("ticker"), F.timestamp_seconds(F.col("id") * 86400).alias("at"), F.rand(4).alias("close"))
    df = ticks.unionByName(daily)
    at = F.unix_micros("at")
    cuts = rolling._cut_points(df, "ticker", at, 1000)
    assert [r.ticker for r in cuts.collect()] == ["busy"]
    parts = df.join(cuts, "ticker").groupBy(rolling._part(F.col("_cuts"), at).alias("part")).count().collect()
    assert len(parts) == 40 and max(r["count"] for r in parts) <= 600
    assert rolling._cut_points(daily, "ticker", at, 1000) is None
    plan = plan_of(rolling.trailing_averages(daily, {"a": 5}, order=("at",), bucket="size", most_rows=1000))
    assert plan.count("Exchange") == 1
