"""The mart as readers get it: written, audited and published as one version.

    data/version=V/mart      the mart's rows
    data/version=V/brief     the lines of every date's brief, by brief_date
    status/version=V         one row: whether it may be served, trust and breaker of each source, newest date

A version exists for readers once its status row does, which is the last thing written: one file, committed at once. The
tests of the mart are counted by the write itself; a build that breaks one leaves no status row, so readers stay with
the version before. Readers take the newest status row, which decides alone, and then at most one stored table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from sieveline import config as C
from sieveline.operators import checks
from sieveline.plans import serving
from sieveline.schemas import extended
from sieveline.sources.snapshots import even_files, exists, remove

STATUS = extended(
    StructType([]),
    "can_serve boolean, stocks_trust double, news_trust double, stocks_blocked boolean, news_blocked boolean, data_date date, "
    "version bigint",
)
BRIEF = extended(StructType([]), "section int, position string, line string, brief_date date")
NEVER_NULL = ("ticker", "date", "close", "stocks_trust_score", "advisor_can_serve")


class BrokenBuild(ValueError):
    """A build that failed its tests; nothing was published."""


class Served:
    """Publishes and reads the versions under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root

    def publish(
        self,
        version: int,
        mart: DataFrame,
        news: DataFrame,
        names: DataFrame | Mapping[str, str] = C.SYMBOL_NAMES,
        n_headlines: int = 8,
        never_null: Sequence[str] = NEVER_NULL,
        keep: int = 2,
    ) -> Row:
        """Writes a version, audits it and switches readers to it; returns its status row.

        Versions before the last ``keep`` go: those who read one have had a whole build's time to end.
        """
        newest = self.current()
        if newest is not None and version <= newest.version:
            raise ValueError(f"version {version} is not after {newest.version}")
        data, audit = f"{self.root}/data/version={version}", Observation()
        mart.observe(audit, F.count(F.lit(1)).alias("rows"), *checks.metrics(never_null)).write.mode("overwrite").parquet(f"{data}/mart")
        failed = {test: n for test, n in audit.get.items() if test != "rows" and n}
        if failed:
            raise BrokenBuild(f"version {version}: " + ", ".join(f"{test}: {n} rows" for test, n in sorted(failed.items())))
        stored = self._spark.read.schema(mart.schema).parquet(f"{data}/mart")
        lines = serving.market_brief(stored, news, names, force=True, n_headlines=n_headlines)
        even_files(lines, ["brief_date"]).write.mode("overwrite").partitionBy("brief_date").parquet(f"{data}/brief")
        serving.serving_status(stored).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/status/version={version}")
        old = self._status().select("version").orderBy(F.desc("version")).offset(keep).collect()
        for row in old:
            remove(self._spark, f"{self.root}/status/version={row.version}")
            remove(self._spark, f"{self.root}/data/version={row.version}")
        return self.current()

    def _status(self) -> DataFrame:
        path = f"{self.root}/status"
        if not exists(self._spark, path):
            return self._spark.createDataFrame([], STATUS)
        return self._spark.read.schema(STATUS).parquet(path)

    def current(self) -> Row | None:
        """The status row that readers go by; None before the first version."""
        return self._status().orderBy(F.desc("version")).first()

    def status(self) -> DataFrame:
        """The same as a table of one row at most."""
        return self._status().orderBy(F.desc("version")).limit(1)

    def _open(self, row: Row | None, force: bool) -> bool:
        return row is not None and (bool(row.can_serve) or force)

    def context(self, like: StructType, force: bool = False) -> DataFrame:
        """Mart rows of the current version while the breaker is closed, none while it is open.

        ``like`` is the mart's schema. ``force`` serves anyway; ``can_serve`` and ``forced`` tell.
        """
        row = self.current()
        if not self._open(row, force):
            return self._spark.createDataFrame([], extended(like, "can_serve boolean, forced boolean"))
        rows = self._spark.read.schema(like).parquet(f"{self.root}/data/version={row.version}/mart")
        may = bool(row.can_serve)
        return rows.withColumns({"can_serve": F.lit(may), "forced": F.lit(not may)})

    def brief(self, force: bool = False) -> DataFrame:
        """Lines (brief_date, section, position, line) of the current version; a filter on ``brief_date`` prunes directories."""
        row = self.current()
        if not self._open(row, force):
            found = self._spark.createDataFrame([], BRIEF)
        else:
            found = self._spark.read.schema(BRIEF).parquet(f"{self.root}/data/version={row.version}/brief")
        return found.select("brief_date", "section", "position", "line")

    def refusal(self) -> DataFrame:
        """Names of blocked sources and the refusal, both null while serving; from the status row alone."""
        return serving.blocked_sources(self.status())

    def citations(self) -> DataFrame:
        return serving.source_citations(self.status())
