"""One row per key.

Each function filters ``row_number() = 1`` directly on its window, which Spark plans
as a per-key limit on the map side: a key holding a third of all rows sends one row
per map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _first(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1, rank: str = "_rank") -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def upsert_latest(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins: the current rows of an append log.

    ``order`` runs from the write time to a tie-breaker, e.g. ("ingested_at", "seq").
    """
    return _first(log, key, [F.col(c).desc() for c in order]).drop("_rank")


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First wins, in document order."""
    return _first(df, key, [F.col(c).asc() for c in order]).drop("_rank")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The most recent row of every symbol."""
    return upsert_latest(df, key, order)


def top_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every key, numbered in ``rank``."""
    return _first(df, key, order, n, rank)
