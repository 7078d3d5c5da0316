"""Whole runs: gate every source into its stores, build every model into its layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sieveline.functions import rules as R
from sieveline.operators import gate as G
from sieveline.plans import intermediate, mart, staging
from sieveline.schemas import extended
from sieveline.sources.batches import DECISION, BatchStore, GateJob
from sieveline.sources.tables import logged_run


def run_batch(spark: SparkSession, jobs: Mapping[str, GateJob], root: str, batch: int, at_once: int = 4) -> DataFrame:
    """Gate each source against what earlier batches verified, store its decisions and log the run.

    One write per source holds both routes, by verdict and day; then the verified table's touched days are built anew. Up
    to ``at_once`` sources run side by side. A source that fails is logged with its error, the rest go on. Running a
    batch again sees the same earlier batches and replaces its own directories, so nothing is doubled. Returns
    this batch's rows of the run log.
    """
    store = BatchStore(spark, root)

    def run(entry: tuple[str, GateJob]) -> DataFrame:
        name, job = entry

        def decide() -> DataFrame:
            if job.intra_batch and not job.sequence:
                raise ValueError("copies inside a batch are told apart by the order of arrival: name a sequence")
            closed = store.closed_upto(job.rules.source)
            if closed is not None and batch <= closed:
                raise ValueError(f"batch {batch} of {job.rules.source} is closed")
            records = job.records()
            fields = list(job.record_fields) or records.columns
            arrived = F.col(job.sequence).cast("bigint") if job.sequence else F.monotonically_increasing_id()
            numbered = records.withColumn("_arrived", arrived)
            known = store.known(job, records, before=batch) if job.table else None
            gated = G.gate(numbered, job.rules, job.as_of, known, False, "_arrived" if job.intra_batch else None)
            stamped = G.identify(gated, job.rules, fields, "_arrived").withColumn("_checked_at", R.as_time(job.as_of).cast("timestamp"))
            day = F.when(F.col("passed"), store.own_day(job, records.schema)) if job.rules.time_field in records.columns else F.lit(None).cast("date")
            return stamped.withColumn("day", day)

        def write(df: DataFrame) -> None:
            like = df.drop("_arrived", "_checked_at", "failure_code", "failure_detail", "raw_record", "record_id", "passed", "day").schema
            before = store.batch_days(job, like, batch) if job.table and job.dated else []
            df.write.mode("overwrite").partitionBy("passed", "day").parquet(f"{root}/decisions/{job.rules.source}/batch={batch}")
            if job.table and job.dated:
                store.refresh(job, like, sorted({*before, *store.batch_days(job, like, batch)}))

        return logged_run(spark, f"{name}-{batch}", name, decide, write, "no records")

    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), jobs.items()))
    log = reduce(DataFrame.unionByName, rows)
    log.coalesce(1).write.mode("overwrite").parquet(f"{root}/runs/batch={batch}")
    return spark.read.schema(log.schema).parquet(f"{root}/runs/batch={batch}")


def gate_to_store(job: GateJob, path: str) -> DataFrame:
    """Gate one source and store every decision once, partitioned by ``passed``.

    One write gives both routes: ``passed=true`` is the verified zone, ``passed=false``
    the quarantine. Nothing is cached and no record is checked twice. ``path`` holds this one
    run; ``run_batch`` keeps all.
    """
    records = job.records()
    verified = job.verified() if job.verified else None
    gated = G.gate(records, job.rules, job.as_of, verified, job.verified_unique, job.intra_batch)
    fields = list(job.record_fields) or records.columns
    G.identify(gated, job.rules, fields, job.intra_batch).write.mode("overwrite").partitionBy("passed").parquet(path)
    decided = extended(records.schema, DECISION)
    return records.sparkSession.read.schema(decided).parquet(path)


def gate_all_sources(spark: SparkSession, jobs: Mapping[str, GateJob], root: str) -> DataFrame:
    """Run each job; a source that fails is reported with its error, the rest go on.

    Returns one summary row per source, read from the stored decisions.
    """
    rows = []
    for name, job in jobs.items():
        try:
            stored = gate_to_store(job, f"{root}/{name}")
            rows.append(G.summary(stored, name).withColumn("error", F.lit(None).cast("string")))
        except Exception as error:  # one broken source must not stop the run
            reason = f"{type(error).__name__}: {error}"
            rows.append(
                spark.range(1).select(
                    F.lit(name).alias("source"),
                    *[F.lit(None).cast("bigint").alias(c) for c in ("total", "passed", "failed")],
                    F.lit(reason).alias("error"),
                )
            )
    return reduce(DataFrame.unionByName, rows)


@dataclass(frozen=True)
class Model:
    """A model of a layer: its schema, "view" or "table", and how it is built.

    ``build`` gets a function from the name of an earlier model to its rows.
    """

    schema: str
    kind: str
    build: Callable[[Callable[[str], DataFrame]], DataFrame]


def _same_shape(a: StructType, b: StructType) -> bool:
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def materialize(spark: SparkSession, models: Mapping[str, Model], root: str) -> DataFrame:
    """Build models in the given order and register them; returns the inventory.

    Views stay queries. Tables are written to a new folder under ``root`` and then registered as external
    tables of their schema: a build that fails leaves the table of the last one in place, and
    readers switch in one step, the change of its location (where the columns changed, the table is made anew). A table of that name that was not built here (a managed
    one) is never dropped. Later models read what was written instead of computing it
    again, and a lost executor costs no more than its part of one model.
    """
    built: dict[str, DataFrame] = {}
    for name, model in models.items():
        df = model.build(built.__getitem__)
        if model.kind == "view":
            df.createOrReplaceTempView(f"{model.schema}_{name}")
            built[name] = df
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {model.schema} LOCATION '{root}/{model.schema}'")
        full = f"{model.schema}.{name}"
        if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "EXTERNAL":
            raise ValueError(f"{full} exists and was not built here")
        path = f"{root}/{model.schema}/{name}-{uuid4().hex}"
        df.write.parquet(path)
        # The table is external: the files of the last build stay for readers at work.
        if spark.catalog.tableExists(full) and _same_shape(spark.table(full).schema, df.schema):
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
            spark.catalog.refreshTable(full)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
        built[name] = spark.table(full)
    return table_inventory(spark, sorted({model.schema for model in models.values() if model.kind == "table"}))


def layers(
    bars: DataFrame,
    news: DataFrame,
    enriched: DataFrame,
    macro: DataFrame,
    gate_results: DataFrame,
    anomalies: DataFrame,
    scale: int = 4,
    price_scale: int = 2,
) -> dict[str, Model]:
    """All models over the verified tables: staging views, intermediate and mart tables."""
    return {
        "stg_stocks": Model("silver", "view", lambda ref: staging.staged_bars(bars, price_scale, scale)),
        "stg_news": Model("silver", "view", lambda ref: staging.staged_news(news, enriched)),
        "stg_macro": Model("silver", "view", lambda ref: staging.staged_macro(macro)),
        "int_stock_daily": Model(
            "silver", "table", lambda ref: intermediate.daily_bars(ref("stg_stocks"), anomalies)
        ),
        "int_news_sentiment_daily": Model(
            "silver", "table", lambda ref: intermediate.daily_sentiment(ref("stg_news"), scale)
        ),
        "int_trust_score_daily": Model(
            "silver", "table", lambda ref: intermediate.trust_scores(gate_results, scale)
        ),
        "mart_symbols": Model(
            "gold",
            "table",
            lambda ref: mart.symbol_mart(
                ref("int_stock_daily"), ref("int_news_sentiment_daily"), ref("int_trust_score_daily"), scale
            ),
        ),
    }


def table_inventory(spark: SparkSession, schemas: list[str]) -> DataFrame:
    """Tables and views of the given schemas, by schema and name, with row counts."""
    entries = {}
    for schema in schemas:
        for table in spark.catalog.listTables(schema):
            kind = "VIEW" if table.isTemporary or table.tableType in ("VIEW", "TEMPORARY") else "BASE TABLE"
            where = "" if table.isTemporary else schema
            entries[(where, table.name)] = kind
    counts = []
    for (schema, name), kind in entries.items():
        rows = spark.table(f"{schema}.{name}" if schema else name)
        counts.append(
            rows.agg(F.count("*").alias("n_rows")).select(
                F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"),
                F.lit(kind).alias("table_type"), "n_rows",
            )
        )
    if not counts:
        return spark.createDataFrame([], "table_schema string, table_name string, table_type string, n_rows bigint")
    return reduce(DataFrame.unionByName, counts).orderBy("table_schema", "table_name")
