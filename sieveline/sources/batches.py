"""What batch runs keep: decisions by day, and the verified tables built from them day by day.

Layout under one root:

    decisions/<source>/batch=N/passed=.../day=...   every decision; ``day`` is the record's own day, for passed ones
    verified/<source>/day=...                       one row per key, the last write
    closed/<source>/upto=N/passed=.../day=...       decisions of closed batches, folded together
    runs/batch=N                                    the run log

A fresh record lies in the few days that its source's age limits allow, so a batch reads and rewrites these days
only, however long the history is. That holds where a key fixes the record's time: the key holds the date,
or the job says ``stable_time`` (an article or a post keeps its time when it comes again). Without that promise
a known key may lie in any day; its lookup reads the keys of the whole history, and its verified
table is a view over the decisions.

A batch that runs again replaces its own decisions; the days it had and the days it has now are built anew from all
batches' decisions, so the result is the same as if it had run once. A crash in between is healed by running
the batch again. The lookup of known keys reads decisions, never the table that is being rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sieveline import config as C
from sieveline.functions import rules as R
from sieveline.operators import gate as G
from sieveline.operators.dedupe import upsert_latest
from sieveline.schemas import TABLES, extended
from sieveline.sources.snapshots import even_files, exists, remove

DECISION = "failure_code string, failure_detail string, raw_record string, record_id string, passed boolean"
MANY_DAYS = 1000  # beyond, days are filtered by range instead of one by one


@dataclass(frozen=True)
class GateJob:
    """One source to gate: its raw records, rules, check time and verified records."""

    rules: C.SourceRules
    records: Callable[[], DataFrame]
    as_of: datetime | Column
    verified: Callable[[], DataFrame] | None = None
    verified_unique: bool = False
    intra_batch: str | None = None
    record_fields: tuple[str, ...] = field(default=())
    # For run_batch: the verified table, how its columns are filled, and the records' order of arrival.
    table: str | None = None
    renamed: Mapping[str, Column] = field(default_factory=dict)
    sequence: str | None = None
    stable_time: bool = False  # a record that comes again has the time it had

    @property
    def dated(self) -> bool:
        """Whether a key lies in one day only."""
        return self.stable_time or self.rules.time_field in self.rules.key


def _in_days(days: list[date]) -> Column:
    """A filter on the partition column that Spark prunes directories by."""
    if not days:
        return F.lit(False)
    if len(days) > MANY_DAYS:
        return F.col("day").between(F.lit(min(days)), F.lit(max(days)))
    return F.col("day").isin(sorted(days))


class BatchStore:
    """Reads and rewrites the kept tables; see the module's text for the layout."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root

    def _read(self, path: str, schema: StructType, base: str | None = None) -> DataFrame:
        if not exists(self._spark, path):
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", base or path).parquet(path)

    @staticmethod
    def _schema(like: StructType) -> StructType:
        return extended(like, f"_arrived bigint, _checked_at timestamp, {DECISION}, batch bigint, day date")

    def closed_upto(self, source: str) -> int | None:
        """The last batch of the latest fold; None without one."""
        path = f"{self.root}/closed/{source}"
        if not exists(self._spark, path):
            return None
        return self._read(path, extended(StructType([]), "upto bigint")).agg(F.max("upto")).first()[0]

    def decisions(self, job: GateJob, like: StructType, before: int | None = None) -> DataFrame:
        """All stored decisions of a source; ``before`` leaves out later batches by directory."""
        source, schema = job.rules.source, self._schema(like)
        found = self._read(f"{self.root}/decisions/{source}", schema)
        upto = self.closed_upto(source)
        if upto is not None:
            base = f"{self.root}/closed/{source}"
            folded = self._read(f"{base}/upto={upto}", schema, f"{base}/upto={upto}")
            # A fold that was stopped before it removed them leaves closed batches' directories behind.
            found = found.filter(F.col("batch") > upto).unionByName(folded)
        return found if before is None else found.filter(F.col("batch") < before)

    def own_day(self, job: GateJob, like: StructType) -> Column:
        """The day of a record's own time."""
        name = job.rules.time_field
        return R.utc_day(R.event_time(name, like[name].dataType, job.rules.date_only))

    def reachable_days(self, job: GateJob, records: DataFrame) -> list[date] | None:
        """Days in which a record of the batch can be known; None where that may be any day.

        For one check time these are the days of its window. A check time per record is settled by the days
        that the batch's fresh records have: one pass over the batch, one row per day back.
        """
        if not job.dated:
            return None
        if not isinstance(job.as_of, Column):
            # One more day on each side covers the time of day and any zone of ``as_of``.
            first = (job.as_of - job.rules.max_age - timedelta(days=1)).date()
            last = (job.as_of + job.rules.max_ahead + timedelta(days=1)).date()
            return [first + timedelta(days=n) for n in range((last - first).days + 1)]
        fresh = G.check(records, job.rules, job.as_of).filter("failure_code is null")
        return [r.day for r in fresh.select(self.own_day(job, records.schema).alias("day")).distinct().collect()]

    def known(self, job: GateJob, records: DataFrame, before: int) -> DataFrame:
        """Verified records of earlier batches, those of reachable days where the store can tell; keys may repeat."""
        passed = self.decisions(job, records.schema, before).filter("passed")
        days = self.reachable_days(job, records)
        return G.verified_rows(passed if days is None else passed.filter(_in_days(days)), TABLES[job.table], job.renamed)

    def _last_written(self, job: GateJob, passed: DataFrame) -> DataFrame:
        keys = {name: f"_key{i}" for i, name in enumerate(job.rules.key)}
        table = TABLES[job.table]
        values = {k: job.renamed[k] if k in job.renamed else F.col(k).try_cast(table[k].dataType) for k in job.rules.key}
        ordered = passed.withColumns({keys[k]: c.alias(keys[k]) for k, c in values.items()})
        return upsert_latest(ordered, list(keys.values()), ["batch", "_arrived"])

    def batch_days(self, job: GateJob, like: StructType, batch: int) -> list[date]:
        """Days of the passed records that a batch has stored, from directory names alone."""
        schema = extended(StructType([]), "passed boolean, day date")
        path = f"{self.root}/decisions/{job.rules.source}/batch={batch}"
        found = self._read(path, schema).filter("passed and day is not null")
        return [r.day for r in found.select("day").distinct().collect()]

    def refresh(self, job: GateJob, like: StructType, days: list[date]) -> None:
        """Builds the verified rows of ``days`` anew; other days are neither read nor written.

        Each day also gets a marker row, so that a day which lost all its rows is replaced as well.
        """
        if not days:
            return
        passed = self.decisions(job, like).filter("passed").filter(_in_days(days))
        last = self._last_written(job, passed)
        rows = G.verified_rows(last, TABLES[job.table], job.renamed, extra=["day"]).withColumn("_marker", F.lit(False))
        marks = self._spark.createDataFrame([(d,) for d in days], "day date").withColumn("_marker", F.lit(True))
        (
            even_files(rows.unionByName(marks, allowMissingColumns=True), ["day"])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(f"{self.root}/verified/{job.rules.source}")
        )

    def verified(self, job: GateJob, like: StructType, before: int | None = None) -> DataFrame:
        """The verified table of a source: one row per key, the last written."""
        table = TABLES[job.table]
        if job.dated and before is None:
            schema = extended(table, "_marker boolean, day date")
            kept = self._read(f"{self.root}/verified/{job.rules.source}", schema)
            return kept.filter("not _marker").select(*[f.name for f in table])
        last = self._last_written(job, self.decisions(job, like, before).filter("passed"))
        return G.verified_rows(last, table, job.renamed)

    def verified_days(self, job: GateJob, days: list[date]) -> DataFrame:
        """The rows of the verified table that lie in ``days``; only their directories are read."""
        schema = extended(TABLES[job.table], "_marker boolean, day date")
        kept = self._read(f"{self.root}/verified/{job.rules.source}", schema)
        return kept.filter("not _marker").filter(_in_days(days)).drop("_marker", "day")

    def fold(self, job: GateJob, like: StructType, upto: int) -> None:
        """Folds the decisions of batches up to ``upto`` into one set of day directories and removes the old ones.

        These batches are closed: they can't run again. Readers switch when the new set is complete; what a stopped fold
        leaves behind is not read and goes with the next one.
        """
        source, before = job.rules.source, self.closed_upto(job.rules.source)
        if before is not None and before >= upto:
            return
        rows = self.decisions(job, like, before=upto + 1)
        target = f"{self.root}/closed/{source}/upto={upto}"
        even_files(rows, ["passed", "day"]).write.mode("overwrite").partitionBy("passed", "day").parquet(target)
        found = self._read(f"{self.root}/decisions/{source}", extended(StructType([]), "batch bigint"))
        for r in found.filter(F.col("batch") <= upto).select("batch").distinct().collect():
            remove(self._spark, f"{self.root}/decisions/{source}/batch={r.batch}")
        if before is not None:
            remove(self._spark, f"{self.root}/closed/{source}/upto={before}")

    def gate_log(self, job: GateJob, like: StructType) -> DataFrame:
        """One row per decision of all runs."""
        return G.gate_log(self.decisions(job, like), job.rules, F.col("_checked_at"))

    def quarantine(self, job: GateJob, like: StructType) -> DataFrame:
        """Failed records of all runs."""
        return G.quarantine_log(self.decisions(job, like), job.rules, F.col("_checked_at"))

    def runs(self) -> DataFrame:
        """The run log."""
        return self._spark.read.schema(extended(TABLES["pipeline_runs"], "batch bigint")).parquet(f"{self.root}/runs")
