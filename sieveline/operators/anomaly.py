"""Unusual closes: the latest row of each symbol against all rows before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline import config as C
from sieveline.operators.dedupe import top_per_key
from sieveline.functions import text as X
from sieveline.sources.snapshots import even_files


def _moments(value: str) -> list[Column]:
    """A state that merges with others: count, mean, squared deviations, extremes."""
    x = F.col(value)
    return [
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("lo"), F.max(x).alias("hi"),
    ]


def _merged(states: DataFrame, key: str) -> DataFrame:
    """One row per key: n_history, avg_close, std_close of all its states; null deviation without one."""
    by_key = Window.partitionBy(key)  # a state per bucket, not a row per bar
    total = F.sum(F.col("n") * F.col("mean")).over(by_key)
    centred = states.withColumn("_mean", F.try_divide(total, F.sum("n").over(by_key)))
    merged = centred.groupBy(key).agg(
        F.sum("n").alias("n_history"),
        F.max("_mean").alias("avg_close"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("_m2"),
        F.min("lo").alias("_lo"),
        F.max("hi").alias("_hi"),
    )
    # Equal values have no deviation at all; rounding in the merge must not invent one.
    deviation = F.when(F.col("_lo") == F.col("_hi"), F.lit(0.0)).otherwise(
        F.sqrt(F.try_divide("_m2", "n_history"))
    )
    return merged.withColumn("std_close", deviation).drop("_m2", "_lo", "_hi")


def _with_history(latest: DataFrame, history: DataFrame, key: str, order: str, value: str) -> DataFrame:
    joined = latest.join(history, key, "left")
    return joined.select(key, order, value, F.coalesce("n_history", F.lit(0)).alias("n_history"), "avg_close", "std_close")


def bucket_states(
    bars: DataFrame, key: str = "ticker", order: str = "date", value: str = "close", bucket: str = "month"
) -> DataFrame:
    """Per (key, bucket of time): the bucket's state and its newest row, from one map-side combined aggregate."""
    cut = F.date_trunc(bucket, F.col(order).cast("timestamp")).alias("bucket")
    rows = bars.filter(F.col(value).isNotNull()).select(key, order, value, cut)
    newest = [F.max(order).alias("last"), F.max_by(value, order).alias("last_value")]
    return rows.groupBy(key, "bucket").agg(*_moments(value), *newest)


def _newest(states: DataFrame, key: str) -> DataFrame:
    newest = states.groupBy(key).agg(F.max_by(F.struct("bucket", "last", "last_value"), "bucket").alias("_newest"))
    return newest.select(key, "_newest.*")


def latest_vs_history(
    bars: DataFrame, key: str = "ticker", order: str = "date", value: str = "close", bucket: str = "month"
) -> DataFrame:
    """Per key: latest date and value; count, mean and population deviation of the rest.

    Bars are reduced to a state per (key, bucket) where they are read and never sorted. The newest bucket of a key is
    taken once more without its latest row, so that row is left out exactly; of the bars only those from the
    earliest newest bucket on are looked at again. No task holds more than the states of a key.
    """
    states = bucket_states(bars, key, order, value, bucket)
    newest = _newest(states, key)
    since = newest.agg(F.min("bucket")).scalar()
    cut = F.date_trunc(bucket, F.col(order).cast("timestamp"))
    late = bars.filter(F.col(value).isNotNull() & (cut >= since)).select(key, order, value, cut.alias("bucket"))
    rest = late.join(newest.select(key, "bucket", "last"), [key, "bucket"]).filter(F.col(order) < F.col("last"))
    columns = [key, "n", "mean", "m2", "lo", "hi"]
    older = states.join(newest.select(key, F.col("bucket").alias("_last")), key).filter(F.col("bucket") < F.col("_last"))
    history = _merged(older.select(columns).unionByName(rest.groupBy(key).agg(*_moments(value)).select(columns)), key)
    latest = newest.select(key, F.col("last").alias(order), F.col("last_value").alias(value))
    return _with_history(latest, history, key, order, value)


def store_states(bars: DataFrame, path: str, key: str = "ticker", order: str = "date", value: str = "close") -> None:
    """Keeps the state of every (key, day); ``bars`` are all rows of the days they lie in, which are replaced.

    A new day costs its own rows: nothing of other days is read or written.
    """
    states = bucket_states(bars, key, order, value, "day").withColumn("day", F.to_date("bucket"))
    even_files(states, ["day"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def latest_from_states(
    states: DataFrame, key: str = "ticker", order: str = "date", value: str = "close"
) -> DataFrame:
    """The same result as ``latest_vs_history`` from stored states of daily bars, one row per key and day."""
    newest = _newest(states, key)
    older = states.join(newest.select(key, F.col("bucket").alias("_last")), key).filter(F.col("bucket") < F.col("_last"))
    latest = newest.select(key, F.col("last").alias(order), F.col("last_value").alias(value))
    return _with_history(latest, _merged(older, key), key, order, value)


def enough_history(stats: DataFrame, minimum: int = C.ANOMALY_MIN_HISTORY) -> DataFrame:
    """Symbols with enough earlier rows and some spread."""
    return stats.filter((F.col("n_history") >= minimum) & (F.col("std_close") != 0))


def price_anomalies(stats: DataFrame, deviations: float = C.ANOMALY_DEVIATIONS) -> DataFrame:
    """Latest closes at least ``deviations`` away from the mean of their history."""
    move = F.try_divide(F.col("close") - F.col("avg_close"), F.col("avg_close")) * 100
    return (
        enough_history(stats)
        .withColumns(
            {
                "pct_change": move,
                "std_devs": F.abs(F.col("close") - F.col("avg_close")) / F.col("std_close"),
            }
        )
        .withColumn("direction", F.when(F.col("pct_change") > 0, "UP").otherwise("DOWN"))
        .filter(F.col("std_devs") >= deviations)
    )


def new_anomalies(found: DataFrame, recorded: DataFrame) -> DataFrame:
    """Leave out (ticker, date) pairs already recorded."""
    return found.join(recorded.select("ticker", F.col("date").cast("date").alias("date")), ["ticker", "date"], "left_anti")


def anomaly_rows(found: DataFrame, explanation: Column, detected_at: Column) -> DataFrame:
    """Rows of ``stock_anomalies``; the identifier is a hash of symbol and date."""
    return found.select(
        F.sha2(F.concat_ws("|", "ticker", F.col("date").cast("string")), 256).alias("anomaly_id"),
        "ticker",
        "date",
        "close",
        F.col("avg_close").alias("avg_close_30d"),
        "pct_change",
        "std_devs",
        explanation.cast("string").alias("explanation"),
        detected_at.cast("timestamp").alias("detected_at"),
    )


def _by_confidence() -> list[Column]:
    return [F.col("confidence").desc(), F.col("article_id").asc()]


def symbol_headlines(news: DataFrame, minimum: float = 0.5, n: int = 3, symbols: DataFrame | None = None) -> DataFrame:
    """The ``n`` most confident headlines that mention each symbol, or each of ``symbols`` (a column ticker).

    ``news`` has article_id, title, sentiment, confidence, tickers_mentioned (array).
    """
    mentions = (
        news.filter(F.col("confidence") >= minimum)
        .select(
            "article_id", "title", "sentiment", "confidence",
            F.explode(F.array_distinct("tickers_mentioned")).alias("ticker"),
        )
    )
    if symbols is not None:
        mentions = mentions.join(symbols.select("ticker").distinct(), "ticker", "left_semi")
    return top_per_key(mentions, ["ticker"], _by_confidence(), n)


def market_headlines(news: DataFrame, minimum: float = 0.7, n: int = 3) -> DataFrame:
    """The ``n`` most confident headlines with a direction, over all symbols."""
    return (
        news.filter((F.col("confidence") >= minimum) & (F.col("sentiment") != "neutral"))
        .select("article_id", "title", "sentiment", "confidence")
        .orderBy(*_by_confidence())
        .limit(n)
    )


def _joined_lines(item: Column, order: list[str]) -> Column:
    """Rendered headlines of a bounded group, one per line."""
    sorted_lines = F.sort_array(F.collect_list(F.struct(*order, item.alias("line"))))
    return F.array_join(F.transform(sorted_lines, lambda entry: entry["line"]), "\n")


def headline_context(anomalies: DataFrame, news: DataFrame) -> DataFrame:
    """Add ``news_context``: own headlines, else market-wide ones, else empty text."""
    line = X.headline_bullet(F.col("sentiment"), F.col("confidence"), F.col("title"))
    own = symbol_headlines(news, symbols=anomalies).groupBy("ticker").agg(_joined_lines(line, ["rank"]).alias("_own"))
    # At most three rows reach this aggregate; its one value is inlined as a scalar subquery.
    market = (
        market_headlines(news)
        .withColumn("_least", -F.col("confidence"))
        .agg(F.count("*").alias("n"), _joined_lines(line, ["_least", "article_id"]).alias("text"))
        .select(F.when(F.col("n") > 0, F.concat(F.lit(X.MARKET_WIDE_PREFIX), F.col("text"))))
    )
    return (
        anomalies.join(own, "ticker", "left")
        .withColumn("news_context", F.coalesce("_own", market.scalar(), F.lit("")))
        .drop("_own")
    )


def anomaly_prompts(anomalies: DataFrame, template: str = X.ANOMALY_TEMPLATE) -> DataFrame:
    """One request text per anomaly; needs the columns of ``headline_context``."""
    context = F.when(F.col("news_context") == "", F.lit(X.NO_HEADLINES)).otherwise(F.col("news_context"))
    prompt = X.render(
        template,
        ticker=X.symbol_clean(F.col("ticker")),
        close=F.col("close").cast("string"),
        average=X.fixed(F.col("avg_close"), 2),
        move=X.signed_pct(F.col("pct_change")),
        direction=F.when(F.col("pct_change") > 0, "above average").otherwise("below average"),
        deviations=X.fixed(F.col("std_devs"), 1),
        headlines=context,
    )
    return anomalies.select("ticker", "date", prompt.alias("prompt"))
