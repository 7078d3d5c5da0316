"""The per-symbol mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.functions.text import fixed
from sieveline.operators.dedupe import latest_per_key
from sieveline.plans.staging import loaded


def latest_trust(trust: DataFrame, source: str) -> DataFrame:
    """One row: date, trust score and breaker of the newest day of a source (nulls if none)."""
    newest = trust.filter(F.col("source") == source).agg(
        F.max_by(F.struct("date", "trust_score", "is_blocked"), "date").alias("_newest")
    )
    return newest.select(F.lit(source).alias("source"), "_newest.date", "_newest.trust_score", "_newest.is_blocked")


def source_status(trust: DataFrame) -> DataFrame:
    """The newest state of every source, in the shape of ``source_status``."""
    newest = latest_per_key(trust, ["source"], ["date"])
    reason = F.concat(F.lit("pass rate "), fixed(F.col("pass_rate") * 100, 2), F.lit("% below the limit"))
    return newest.select(
        "source",
        F.col("date").cast("timestamp").alias("updated_at"),
        "trust_score",
        "is_blocked",
        F.when(F.col("is_blocked"), reason).alias("block_reason"),
    )


def pct_from_average(close: Column, average: Column, scale: int = 4) -> Column:
    """Distance of a close from its average in percent, null without an average."""
    return F.round(F.try_divide(close - average, average) * 100, scale)


def can_serve(blocked: list[Column], fail_closed: bool = False) -> Column:
    """False if any source is blocked. A source without a score counts as open, or as
    blocked with ``fail_closed``."""
    held = F.lit(False)
    for flag in blocked:
        held = held | F.coalesce(flag, F.lit(fail_closed))
    return ~held


def symbol_mart(
    bars: DataFrame, sentiment: DataFrame, trust: DataFrame, scale: int = 4, fail_closed: bool = False
) -> DataFrame:
    """Daily bars with the day's sentiment and each source's latest trust.

    Both sources' latest trust come from one aggregate, read once as a scalar subquery and inlined.
    """

    def newest(source: str) -> Column:
        own = F.col("source") == source
        return F.max_by(F.when(own, F.struct("trust_score", "is_blocked")), F.when(own, F.col("date"))).alias(source)

    state = trust.agg(newest("stocks"), newest("news")).select(F.struct("stocks", "news")).scalar()
    daily = sentiment.select(
        "date",
        F.col("dominant_sentiment").alias("market_sentiment"),
        "bullish_score",
        "bearish_score",
        "article_count",
        F.col("avg_confidence").alias("sentiment_confidence"),
    )
    joined = bars.drop("_loaded_at").join(daily, "date", "left")
    blocked = [F.col("stocks_blocked"), F.col("news_blocked")]
    return loaded(
        joined.withColumn("_state", state)
        .withColumns(
            {
                "pct_from_30d_avg": pct_from_average(F.col("close"), F.col("avg_close_30d"), scale),
                "stocks_trust_score": F.col("_state.stocks.trust_score"),
                "stocks_blocked": F.col("_state.stocks.is_blocked"),
                "news_trust_score": F.col("_state.news.trust_score"),
                "news_blocked": F.col("_state.news.is_blocked"),
            }
        )
        .withColumn("advisor_can_serve", can_serve(blocked, fail_closed))
        .select(
            "ticker", "date", "open", "high", "low", "close", "volume", "price_range", "intraday_pct_change",
            "avg_close_7d", "avg_close_30d", "pct_from_30d_avg", "market_sentiment", "bullish_score",
            "bearish_score", "article_count", "sentiment_confidence", "is_anomaly", "anomaly_explanation",
            "stocks_trust_score", "stocks_blocked", "news_trust_score", "news_blocked", "advisor_can_serve",
        )
    )
