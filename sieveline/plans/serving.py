"""Questions asked of the mart: status, citations, guarded rows, rendered lines, briefs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sieveline import config as C
from sieveline.functions import rules as R, text as X
from sieveline.operators.dedupe import top_per_key

NO_NEWS = "No headline of this day has a direction and enough confidence."
SOURCE_TITLES = {"stocks": "Stock prices", "news": "Financial news with enrichment"}


def serving_status(mart: DataFrame) -> DataFrame:
    """One row: whether the mart may be served, trust and breaker per source, newest date."""
    return mart.agg(
        F.bool_and("advisor_can_serve").alias("can_serve"),
        F.max("stocks_trust_score").alias("stocks_trust"),
        F.max("news_trust_score").alias("news_trust"),
        F.bool_or("stocks_blocked").alias("stocks_blocked"),
        F.bool_or("news_blocked").alias("news_blocked"),
        F.max("date").alias("data_date"),
    )


def source_citations(status: DataFrame, titles: Mapping[str, str] = SOURCE_TITLES) -> DataFrame:
    """One row per source that has a trust score."""

    def citation(name: str) -> Column:
        trust = F.col(f"{name}_trust")
        blocked = F.coalesce(F.col(f"{name}_blocked"), F.lit(False))
        note = F.concat(
            F.lit("Trust score: "), X.fixed(trust * 100, 1), F.lit("% — "),
            F.when(blocked, "BLOCKED").otherwise("verified"),
        )
        return F.struct(
            F.lit(titles[name]).alias("source"),
            F.round(trust, 3).alias("trust_score"),
            blocked.alias("is_blocked"),
            note.alias("verified_note"),
        )

    rows = status.select(F.inline(F.array(*[citation(name) for name in titles])))
    return rows.filter(F.col("trust_score").isNotNull())


def may_serve(status: DataFrame) -> Column:
    """The breaker as a scalar subquery; an empty mart is not served."""
    return status.select(F.coalesce("can_serve", F.lit(False))).scalar()


def guarded_context(mart: DataFrame, force: bool = False) -> DataFrame:
    """Mart rows while the breaker is closed, none while it is open.

    ``force`` serves anyway; ``can_serve`` still tells the real state and ``forced``
    that it was overridden.
    """
    return (
        mart.withColumn("can_serve", may_serve(serving_status(mart)))
        .withColumn("forced", F.lit(force) & ~F.col("can_serve"))
        .filter(F.col("can_serve") | F.lit(force))
    )


def context_symbols(mart: DataFrame) -> DataFrame:
    """The columns a brief needs, by symbol and date."""
    return mart.select(
        "ticker", "date", "close", "intraday_pct_change", "avg_close_7d", "avg_close_30d", "pct_from_30d_avg",
        "market_sentiment", "bullish_score", "bearish_score", "sentiment_confidence", "is_anomaly",
        "anomaly_explanation", "advisor_can_serve",
    ).orderBy("ticker", "date")


def _strong(news: DataFrame, minimum: float) -> DataFrame:
    return news.filter((F.col("confidence") >= minimum) & (F.col("sentiment") != "neutral"))


def top_headlines(news: DataFrame, minimum: float = 0.7, n: int = 8) -> DataFrame:
    """The ``n`` most confident headlines with a direction."""
    return (
        _strong(news, minimum)
        .select("article_id", "title", "sentiment", "confidence", "market_implication", "topic_tags")
        .orderBy(F.col("confidence").desc(), "article_id")
        .limit(n)
    )


def symbol_names(rows: DataFrame, names: DataFrame | Mapping[str, str] = C.SYMBOL_NAMES) -> DataFrame:
    """Add ``display_name``, the symbol itself where no name is known.

    A mapping is a few configured entries and becomes a literal map. A table (ticker,
    name) is joined, one name per symbol, by whatever join its size asks for.
    """
    if isinstance(names, DataFrame):
        known = names.groupBy("ticker").agg(F.min("name").alias("_name"))
        return (
            rows.join(known, "ticker", "left")
            .withColumn("display_name", F.coalesce("_name", "ticker"))
            .drop("_name")
        )
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    if not pairs:
        return rows.withColumn("display_name", F.col("ticker"))
    return rows.withColumn("display_name", F.coalesce(F.create_map(*pairs)[F.col("ticker")], F.col("ticker")))


def symbol_line() -> Column:
    """One line per mart row; parts that are zero or absent are left out."""

    def worth(name: str) -> Column:
        return F.coalesce(F.col(name) != 0, F.lit(False))

    day = F.when(
        worth("intraday_pct_change"), F.concat(F.lit(" ("), X.signed_pct(F.col("intraday_pct_change")), F.lit(" intraday)"))
    )
    average = F.when(
        worth("avg_close_30d"),
        F.concat(
            F.lit(" | 30d avg ₹"), X.fixed(F.col("avg_close_30d"), 2),
            F.lit(" ("), X.signed_pct(F.col("pct_from_30d_avg")), F.lit(")"),
        ),
    )
    explained = F.col("is_anomaly") & (F.coalesce("anomaly_explanation", F.lit("")) != "")
    anomaly = F.when(explained, F.concat(F.lit(" ⚠️ ANOMALY: "), F.col("anomaly_explanation")))
    return F.concat(
        F.col("display_name"), F.lit(" ("), X.symbol_clean(F.col("ticker")), F.lit("): ₹"),
        F.col("close").cast("string"),
        *[F.coalesce(part, F.lit("")) for part in (day, average, anomaly)],
    )


def symbol_lines(mart: DataFrame, names: DataFrame | Mapping[str, str] = C.SYMBOL_NAMES) -> DataFrame:
    return symbol_names(mart, names).select("ticker", "date", symbol_line().alias("line"))


def headline_line() -> Column:
    return F.concat(
        F.lit("["), F.upper("sentiment"), F.lit(" "), X.whole_pct(F.col("confidence")), F.lit("] "),
        F.coalesce("title", F.lit("")), F.lit("\n  → "), F.coalesce("market_implication", F.lit("")),
    )


def headline_lines(headlines: DataFrame) -> DataFrame:
    return headlines.select("article_id", headline_line().alias("line"))


def blocked_sources(status: DataFrame, titles: Mapping[str, str] = SOURCE_TITLES) -> DataFrame:
    """One row: names of blocked sources and the refusal, both null while serving."""
    names = F.concat_ws(", ", *[F.when(F.col(f"{n}_blocked"), F.lit(title)) for n, title in titles.items()])
    refused = ~F.coalesce("can_serve", F.lit(False))
    return status.select(
        F.when(refused, names).alias("blocked"),
        F.when(
            refused,
            F.concat(
                F.lit("No answer now: these sources failed their quality checks: "), names,
                F.lit(". Ask again after the next run."),
            ),
        ).alias("refusal"),
    )


def market_brief(
    mart: DataFrame,
    news: DataFrame,
    names: DataFrame | Mapping[str, str] = C.SYMBOL_NAMES,
    force: bool = False,
    n_headlines: int = 8,
) -> DataFrame:
    """One brief per date, as lines (brief_date, section, position, line).

    Reading a date's lines by section and position gives its text; ``write_brief``
    stores them so. Lines stay rows because a date's symbols are not bounded: putting
    them into one string would gather them in one task.
    """
    context = guarded_context(mart, force)
    day = F.col("date").alias("brief_date")
    ranked = top_per_key(
        _strong(news, 0.7).withColumn("date", R.utc_day(F.col("published_at"))),
        ["date"],
        [F.col("confidence").desc(), F.col("article_id")],
        n_headlines,
    )
    # One row per date on either side.
    moods = context.groupBy("date").agg(F.max("market_sentiment").alias("mood"))
    moods = moods.join(ranked.groupBy("date").agg(F.count("*").alias("n")), "date", "left")
    n = F.coalesce("n", F.lit(0))
    mood = F.concat(
        F.lit("SENTIMENT: "), F.upper(F.coalesce("mood", F.lit("neutral"))),
        F.lit(" ("), n.cast("string"), F.when(n == 1, " article)").otherwise(" articles)"),
    )
    header = moods.select(
        day,
        F.inline(
            F.filter(
                F.array(
                    _line(0, F.lit("a"), F.concat(F.lit("DATA AS OF: "), F.col("date").cast("string"))),
                    _line(0, F.lit("b"), F.lit("Every record below passed the quality gate.")),
                    _line(1, F.lit(""), F.lit("PRICES")),
                    _line(2, F.lit(""), mood),
                    _line(2, F.lit("0000"), F.when(n == 0, NO_NEWS)),
                ),
                lambda entry: entry["line"].isNotNull(),
            )
        ),
    )
    prices = symbol_names(context, names).select(
        day, F.lit(1).alias("section"), F.col("ticker").alias("position"), symbol_line().alias("line")
    )
    headlines = ranked.select(
        "date", F.lit(2).alias("section"), F.lpad(F.col("rank").cast("string"), 4, "0").alias("position"),
        headline_line().alias("line"),
    )
    # Only dates that have a brief.
    headlines = headlines.join(moods.select("date"), "date", "left_semi").withColumnRenamed("date", "brief_date")
    return header.unionByName(prices).unionByName(headlines)


def _line(section: int, position: Column, line: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), position.alias("position"), line.alias("line"))


def write_brief(lines: DataFrame, path: str) -> None:
    """Text files under brief_date=...; range partitioning keeps the lines of a date in
    order across its files and spreads a long brief over several."""
    (
        lines.repartitionByRange("brief_date", "section", "position")
        .sortWithinPartitions("brief_date", "section", "position")
        .select("brief_date", "line")
        .write.partitionBy("brief_date")
        .mode("overwrite")
        .text(path)
    )
