"""Status, breaker, rendered lines and briefs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sieveline.plans import serving as S
from sieveline.session import scratch_dir

MART = (
    "ticker string, date date, close double, intraday_pct_change double, avg_close_7d double, avg_close_30d double, "
    "pct_from_30d_avg double, market_sentiment string, bullish_score double, bearish_score double, "
    "sentiment_confidence double, is_anomaly boolean, anomaly_explanation string, stocks_trust_score double, "
    "stocks_blocked boolean, news_trust_score double, news_blocked boolean, advisor_can_serve boolean"
)
DAY = date(2024, 1, 2)


def mart(rows, blocked=False):
    common = (0.923, False, 0.81, blocked, not blocked)
    return rows(
        [
            ("TCS.NS", DAY, 118.5, 1.25, 1.0, 110.0, 7.7272, "bullish", 0.5, 0.2, 0.9, True, "results", *common),
            ("ZZ.NS", DAY, 10.0, 0.0, None, None, None, "bullish", 0.5, 0.2, 0.9, False, None, *common),
        ],
        MART,
    )


def news(rows):
    return rows(
        [
            ("1", "Up", "bullish", 0.9, "gain", datetime(2024, 1, 2, 5)),
            ("2", "Flat", "neutral", 0.99, "none", datetime(2024, 1, 2, 6)),
            ("3", "Down", "bearish", 0.7, "loss", datetime(2024, 1, 2, 7)),
            ("4", "Other day", "bearish", 0.8, "loss", datetime(2024, 1, 3, 7)),
        ],
        "article_id string, title string, sentiment string, confidence double, market_implication string, published_at timestamp",
    ).withColumn("topic_tags", F.array(F.lit("x")))


def test_status_and_citations(rows):
    status = S.serving_status(mart(rows, blocked=True))
    row = status.first()
    assert (row.can_serve, row.news_blocked, row.data_date) == (False, True, DAY)
    got = [tuple(r) for r in S.source_citations(status).collect()]
    assert got == [
        ("Stock prices", 0.923, False, "Trust score: 92.3% — verified"),
        ("Financial news with enrichment", 0.81, True, "Trust score: 81.0% — BLOCKED"),
    ]
    blocked = S.blocked_sources(status).first()
    assert blocked.blocked == "Financial news with enrichment" and blocked.blocked in blocked.refusal
    assert S.blocked_sources(S.serving_status(mart(rows))).first().refusal is None


def test_source_without_score_is_not_cited(rows):
    bare = mart(rows).withColumn("news_trust_score", F.lit(None).cast("double"))
    assert S.source_citations(S.serving_status(bare)).count() == 1


def test_breaker(rows):
    assert S.guarded_context(mart(rows)).count() == 2
    assert S.guarded_context(mart(rows, blocked=True)).count() == 0
    forced = S.guarded_context(mart(rows, blocked=True), force=True).collect()
    assert len(forced) == 2 and all(r.forced and not r.can_serve for r in forced)
    assert S.guarded_context(mart(rows).filter("ticker = 'none'")).count() == 0


def test_symbol_lines(rows):
    got = {r.ticker: r.line for r in S.symbol_lines(mart(rows)).collect()}
    assert got["TCS.NS"] == (
        "Tata Consultancy Services (TCS): ₹118.5 (+1.25% intraday) | 30d avg ₹110.00 (+7.73%) ⚠️ ANOMALY: results"
    )
    assert got["ZZ.NS"] == "ZZ.NS (ZZ): ₹10.0"


def test_top_headlines(rows):
    assert [r.title for r in S.top_headlines(news(rows)).collect()] == ["Up", "Other day", "Down"]


def test_brief_reads_in_order(spark, rows):
    lines = S.market_brief(mart(rows), news(rows))
    text = [r.line for r in lines.orderBy("brief_date", "section", "position").collect()]
    assert text == [
        "DATA AS OF: 2024-01-02",
        "Every record below passed the quality gate.",
        "PRICES",
        "Tata Consultancy Services (TCS): ₹118.5 (+1.25% intraday) | 30d avg ₹110.00 (+7.73%) ⚠️ ANOMALY: results",
        "ZZ.NS (ZZ): ₹10.0",
        "SENTIMENT: BULLISH (2 articles)",
        "[BULLISH 90%] Up\n  → gain",
        "[BEARISH 70%] Down\n  → loss",
    ]
    path = scratch_dir(spark, "brief")
    S.write_brief(lines, path)
    stored = spark.read.text(path)
    assert stored.filter(F.col("brief_date") == DAY).count() == 10  # two headlines span two lines each


def test_closed_breaker_gives_no_brief(rows):
    assert S.market_brief(mart(rows, blocked=True), news(rows)).count() == 0


@pytest.mark.parametrize("names", [{}, {"ZZ.NS": "Zed"}])
def test_names_from_mapping_and_table(rows, names):
    frame = rows(list(names.items()) * 2, "ticker string, name string")
    by_table = {r.ticker: r.display_name for r in S.symbol_names(mart(rows), frame).collect()}
    by_map = {r.ticker: r.display_name for r in S.symbol_names(mart(rows), names).collect()}
    assert by_table == by_map == {"TCS.NS": "TCS.NS", "ZZ.NS": names.get("ZZ.NS", "ZZ.NS")}
