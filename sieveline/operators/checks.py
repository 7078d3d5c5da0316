"""Declarative column tests; each returns failure counts, zero where the test holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Null count of each column, all from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures"
    )


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of values that occur more than once, nulls left out."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures"
    )


def accepted_values(df: DataFrame, model: str, column: str, values: Iterable) -> DataFrame:
    """Number of rows holding any other value, nulls left out."""
    return df.agg(F.count_if(~F.col(column).isin(*values)).alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit("accepted_values").alias("test"),
        "failures",
    )


def union_all(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def suite(models: Mapping[str, DataFrame]) -> DataFrame:
    """All declared tests over the given staging and mart models."""
    from sieveline.config import SENTIMENTS

    nulls = {
        "stg_stocks": ("ticker", "date", "close"),
        "stg_news": ("article_id", "sentiment"),
        "stg_macro": ("series_id",),
        "mart": ("ticker", "date", "close", "stocks_trust_score", "advisor_can_serve"),
    }
    results = [not_null(models[m], m, columns) for m, columns in nulls.items() if m in models]
    if "stg_news" in models:
        results.append(unique(models["stg_news"], "stg_news", "article_id"))
        results.append(accepted_values(models["stg_news"], "stg_news", "sentiment", SENTIMENTS))
    return union_all(results)


def mart_profile(mart: DataFrame) -> DataFrame:
    """Row count and the first row by symbol and date, in one aggregate."""
    shown = ["ticker", "date", "close", "market_sentiment", "stocks_trust_score", "advisor_can_serve"]
    profile = mart.agg(F.count("*").alias("n_rows"), F.min(F.struct(*shown)).alias("first"))
    return profile.select("n_rows", "first.*")


def metrics(not_null: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None) -> list[Column]:
    """The same tests as metrics of a write: ``df.observe(name, *metrics(...))`` counts failures while rows pass by."""
    found = [F.count_if(F.col(c).isNull()).alias(f"not_null {c}") for c in not_null]
    for c, values in (accepted or {}).items():
        found.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)).alias(f"accepted_values {c}"))
    return found
