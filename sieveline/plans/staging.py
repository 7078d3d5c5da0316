"""Staging models: typed, filtered views over the verified tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def loaded(df: DataFrame) -> DataFrame:
    """Add the audit column; one value per statement."""
    return df.withColumn("_loaded_at", F.current_timestamp())


def staged_bars(bars: DataFrame, price_scale: int = 2, pct_scale: int = 4) -> DataFrame:
    """Plausible bars with their daily range and open-to-close change."""
    return loaded(
        bars.filter((F.col("close") > 0) & (F.col("volume") >= 0) & (F.col("high") >= F.col("low"))).select(
            "ticker",
            F.col("date").cast("date").alias("date"),
            "open",
            "high",
            "low",
            "close",
            "volume",
            F.round(F.col("high") - F.col("low"), price_scale).alias("price_range"),
            F.round(F.try_divide(F.col("close") - F.col("open"), F.col("open")) * 100, pct_scale).alias(
                "intraday_pct_change"
            ),
            F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        )
    )


def staged_news(news: DataFrame, enriched: DataFrame) -> DataFrame:
    """Verified articles with an enrichment of some confidence."""
    fields = enriched.filter(F.col("confidence") > 0).select(
        "article_id", "sentiment", "confidence", "tickers_mentioned", "topic_tags", "market_implication",
        F.col("enriched_at").cast("timestamp").alias("enriched_at"),
    )
    articles = news.select(
        "article_id", "title", "description", "source_name",
        F.col("published_at").cast("timestamp").alias("published_at"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )
    return loaded(articles.join(fields, "article_id"))


def staged_macro(macro: DataFrame) -> DataFrame:
    """Macro observations that hold a value."""
    return loaded(
        macro.filter(F.col("value").isNotNull()).select(
            "series_id",
            F.col("date").cast("date").alias("date"),
            "value",
            F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        )
    )
