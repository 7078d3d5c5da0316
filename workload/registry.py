"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, TimestampType

from workload.fixtures import Inputs, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a function of ``Inputs``; ``sql`` reads the given fixture views."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Inputs(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql, *views)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """UTC timestamps without a zone, as the SQL side returns them."""
    columns = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema
    ]
    return df.select(*columns) if any(isinstance(f.dataType, TimestampType) for f in df.schema) else df


def r8(name: str | Column, alias: str | None = None) -> Column:
    """Doubles at eight digits, where both engines agree."""
    column = F.col(name) if isinstance(name, str) else name
    return F.round(column, 8).alias(alias or name)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r8(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in df.schema])
