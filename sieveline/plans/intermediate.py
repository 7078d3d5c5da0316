"""Daily models: bars with averages and anomalies, sentiment, trust."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sieveline import config as C
from sieveline.functions import rules as R
from sieveline.operators.rolling import trailing_averages
from sieveline.plans.staging import loaded


def moving_averages(staged: DataFrame, bucket: str = "year", most_rows: int = 1_000_000) -> DataFrame:
    """Average close over the last 7 and 30 rows of each symbol."""
    return trailing_averages(staged, {"avg_close_7d": 7, "avg_close_30d": 30}, bucket=bucket, most_rows=most_rows)


def daily_bars(staged: DataFrame, anomalies: DataFrame, bucket: str = "year") -> DataFrame:
    """One row per symbol and day: bar, trailing averages, anomaly flag and explanation."""
    flags = anomalies.select(
        "ticker", F.col("date").cast("date").alias("date"), F.lit(True).alias("_flag"),
        F.col("explanation").alias("anomaly_explanation"),
    )
    return loaded(
        moving_averages(staged.drop("_loaded_at", "ingested_at"), bucket)
        .join(flags, ["ticker", "date"], "left")
        .withColumn("is_anomaly", F.col("_flag").isNotNull())
        .drop("_flag")
    )


def daily_sentiment(news: DataFrame, scale: int = 4) -> DataFrame:
    """Confidence-weighted shares per day and the leading direction (a tie is neutral)."""

    def weight(label: str) -> Column:
        return F.sum(F.when(F.col("sentiment") == label, F.col("confidence")).otherwise(F.lit(0.0)))

    weights = (
        news.filter(F.col("confidence") > 0)
        .groupBy(R.utc_day(F.col("published_at")).alias("date"))
        .agg(
            F.count("*").alias("article_count"),
            F.round(F.avg("confidence"), scale).alias("avg_confidence"),
            F.sum("confidence").alias("_total"),
            *[weight(label).alias(f"_{label}") for label in C.SENTIMENTS],
        )
    )
    return loaded(
        weights.select(
            "date",
            "article_count",
            "avg_confidence",
            *[F.try_divide(f"_{label}", "_total").alias(f"{label}_score") for label in C.SENTIMENTS],
            # The order of addition varies between runs; its last bits must not decide a tie.
            dominant_sentiment(F.round("_bullish", 8), F.round("_bearish", 8)).alias("dominant_sentiment"),
        )
    )


def dominant_sentiment(bullish: Column, bearish: Column) -> Column:
    return F.when(bullish > bearish, "bullish").when(bearish > bullish, "bearish").otherwise("neutral")


def severity(code: Column, weights: Mapping[str, float] = C.SEVERITY) -> Column:
    value = F.lit(0.0)
    for name, weight in weights.items():
        value = F.when(code == name, F.lit(float(weight))).otherwise(value)
    return value


def circuit_breaker(metric: Column, threshold: float = C.BREAKER_THRESHOLD) -> Column:
    """True where a source must not be served."""
    return F.coalesce(F.round(metric, 4) < threshold, F.lit(False))


def trust_scores(
    results: DataFrame,
    scale: int = 4,
    threshold: float = C.BREAKER_THRESHOLD,
    breaker_metric: str = "pass_rate",
) -> DataFrame:
    """Per day and source: counts, pass rate, severity-weighted trust, breaker.

    One map-side combined aggregate, so a source with most of the rows costs nothing
    extra. ``breaker_metric`` is "pass_rate" or "trust_score".
    """
    counted = results.groupBy(R.utc_day(F.col("checked_at")).alias("date"), "source").agg(
        F.count("*").alias("records_checked"),
        F.count_if(F.col("passed")).alias("records_passed"),
        F.count_if(~F.col("passed")).alias("records_failed"),
        F.sum(severity(F.col("failure_code"))).alias("_weight"),
    )
    checked = F.col("records_checked").cast("double")
    scored = counted.withColumns(
        {
            "pass_rate": F.col("records_passed") / checked,
            "trust_score": 1.0 - F.col("_weight") / (checked * C.WORST_SEVERITY),
        }
    )
    return loaded(
        scored.withColumn("is_blocked", circuit_breaker(F.col(breaker_metric), threshold))
        .withColumns({name: F.round(name, scale) for name in ("pass_rate", "trust_score")})
        .drop("_weight")
    )
