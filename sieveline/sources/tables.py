"""Named sources and the keyed append logs behind the verified tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce
from threading import Thread

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sieveline import schemas
from sieveline.operators.dedupe import upsert_latest
from sieveline.session import scratch_dir
from sieveline.sources.snapshots import even_files, exists, remove


class Sources:
    """Declared sources by name; each is a parquet path or a catalog table.

    A declared table of the data model that holds nothing yet reads as empty.
    """

    def __init__(self, spark: SparkSession, declared: Mapping[str, str]):
        self._spark = spark
        self._declared = dict(declared)

    def names(self) -> list[str]:
        return sorted(self._declared)

    def scan(self, name: str) -> DataFrame:
        if name not in self._declared:
            raise KeyError(f"no source named {name!r} is declared")
        where = self._declared[name]
        try:
            if "/" in where:
                return self._spark.read.parquet(where)
            return self._spark.read.table(where)
        except AnalysisException as error:
            missing = error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
            if missing and name in schemas.TABLES:
                return schemas.empty(self._spark, name)
            raise


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a keyed log; readers take the latest per key."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def current(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current rows of a keyed log."""
    return upsert_latest(spark.read.parquet(path), key, order)


def compact(
    spark: SparkSession, path: str, target: str, key: Sequence[str], order: Sequence[str],
    partition_by: Sequence[str] = (),
) -> None:
    """Write the current rows of a log to a new path; never the one being read."""
    if path.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact to a new path: the log is read while it is written")
    rows = current(spark, path, key, order)
    if partition_by:
        rows = even_files(rows, list(partition_by))
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(target)


def merge_by_day(changes: DataFrame, path: str, key: Sequence[str], order: Sequence[str], day: str = "day") -> None:
    """Merges rows into a table partitioned by ``day``, the last write of each key by ``order``; only their days are rewritten.

    The changes and the merged days are written aside first: a job that reads a day can't replace it, and what a lost
    executor costs is a part of one step. Merging the same changes again gives the same table.
    """
    spark = changes.sparkSession
    aside = scratch_dir(spark, "merge")
    changes.write.parquet(f"{aside}/changes")
    rows = spark.read.schema(changes.schema).parquet(f"{aside}/changes")
    days = [r[0] for r in rows.select(day).distinct().collect()]  # calendar days
    if days:
        if exists(spark, path):
            rows = rows.unionByName(spark.read.schema(changes.schema).parquet(path).filter(F.col(day).isin(days)))
        upsert_latest(rows, key, order).write.parquet(f"{aside}/merged")
        merged = spark.read.schema(changes.schema).parquet(f"{aside}/merged")
        writer = even_files(merged, [day]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(day).parquet(path)
    remove(spark, aside)


def _run_row(spark: SparkSession, run_id: str, source: str, records: int, status: str, error: str | None) -> DataFrame:
    """One row of the run log; its time is fixed here and does not change with each read."""
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(source).alias("source"),
        F.lit(datetime.now(timezone.utc)).alias("run_at"),
        F.lit(records).cast("bigint").alias("records"),
        F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error"),
    )


def _observed(counted: Observation, wait: float) -> int:
    """The observed count; raises where no action has delivered one in time."""
    found: list[int] = []
    reader = Thread(target=lambda: found.append(counted.get["records"]), daemon=True)
    reader.start()
    reader.join(wait)
    if not found:
        raise RuntimeError("the write ran no action")
    return found[0]


def logged_run(
    spark: SparkSession,
    run_id: str,
    source: str,
    load: Callable[[], DataFrame],
    write: Callable[[DataFrame], None],
    empty_note: str | None = None,
    wait: float = 30.0,
) -> DataFrame:
    """Load and write one source; returns its row of the run log.

    Records are counted by the write itself. A run that raises is logged as failed with
    its error, one that wrote nothing as a success with ``empty_note``. A ``write`` that runs no
    action gives no count: after ``wait`` seconds that is a failure too.
    """
    try:
        df, counted = load(), Observation()
        write(df.observe(counted, F.count(F.lit(1)).alias("records")))
        records = _observed(counted, wait)
    except Exception as error:  # logged, so that the other sources still run
        return _run_row(spark, run_id, source, 0, "failed", f"{type(error).__name__}: {error}")
    return _run_row(spark, run_id, source, records, "success", empty_note if records == 0 else None)


def store_channels(
    spark: SparkSession, channels: Mapping[str, Callable[[], DataFrame]], path: str, run_id: str, at_once: int = 4
) -> DataFrame:
    """Stores each channel under ``path/run=<run_id>/channel=<name>`` by a job of its own; returns their rows of the run log.

    Up to ``at_once`` jobs run side by side. A channel that can't be read, or breaks while it runs, is logged with its error
    and leaves nothing; the others are stored. ``stored_channels`` reads a run.
    """

    def run(entry: tuple[str, Callable[[], DataFrame]]) -> DataFrame:
        name, load = entry
        target = f"{path}/run={run_id}/channel={name}"
        row = logged_run(spark, f"{name}-{run_id}", name, load, lambda df: df.write.mode("overwrite").parquet(target), "no records")
        if row.first().status == "failed":
            remove(spark, target)
        return row

    with ThreadPoolExecutor(max(1, min(at_once, len(channels)))) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(spark)(run), channels.items()))


def stored_channels(spark: SparkSession, path: str, run_id: str, column: str = "channel") -> DataFrame:
    """All channels of a run in one table; fields that a channel lacks are null."""
    base = f"{path}/run={run_id}"
    found = spark.read.option("mergeSchema", "true").option("basePath", base).parquet(base)
    return found if column == "channel" else found.withColumnRenamed("channel", column)
