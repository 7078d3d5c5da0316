"""Dated JSON snapshots of each zone: raw, verified, quarantine, enriched."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sieveline.schemas import extended


def even_files(df: DataFrame, columns: list[str]) -> DataFrame:
    """Gather rows of a partition directory before writing.

    The rebalance hint lets adaptive execution split a day that holds most of the rows
    and merge small ones, so there is neither a hot task nor a file per task and day.
    """
    return df.hint("rebalance", *columns)


def write_snapshot(
    df: DataFrame, zone: str, source: str, day: date | str | None = None, day_column: str | None = None
) -> None:
    """Replace the snapshot of each day present, other days stay.

    Layout ``zone/feed=.../day=YYYY-MM-DD``; the record's own fields stay as they are, a
    field ``source`` among them. The day is one given value or taken per row from ``day_column``.
    """
    when = F.col(day_column).cast("date") if day_column else F.lit(str(day)).cast("date")
    stamped = df.withColumns({"feed": F.lit(source), "day": when})
    if day_column:
        stamped = even_files(stamped, ["day"])
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("feed", "day")
        .json(zone)
    )


def read_snapshot(
    spark: SparkSession,
    zone: str,
    schema: StructType,
    source: str | None = None,
    day: date | str | None = None,
    whole_file: bool = False,
) -> DataFrame:
    """Records of a zone with partition columns ``feed`` (the snapshot's source) and ``day``.

    Filters on both prune directories. One JSON value per line is the splittable
    default; ``whole_file`` reads files that hold a single JSON array. Lines that do not
    parse keep their text in ``_corrupt_record`` where the schema has that field.
    """
    added = {"feed": "feed string", "day": "day date"}
    absent = [ddl for name, ddl in added.items() if name not in schema.fieldNames()]
    full = extended(schema, ", ".join(absent)) if absent else schema
    df = spark.read.schema(full).option("multiLine", whole_file).option("mode", "PERMISSIVE").json(zone)
    if source is not None:
        df = df.filter(F.col("feed") == source)
    if day is not None:
        df = df.filter(F.col("day") == F.lit(str(day)).cast("date"))
    return df


def write_json_arrays(df: DataFrame, path: str, day_column: str, most: int = 20_000) -> None:
    """Files ``path/d=<day>/*`` that each hold one JSON array of about ``most`` records at most.

    An array is read by one task, so a day with more records gets several files, dealt by a hash of the records.
    """
    days = df.groupBy(F.col(day_column).alias("_day")).agg(F.ceil(F.count("*") / most).alias("_files"))
    dealt = df.join(F.broadcast(days), F.col(day_column).eqNullSafe(F.col("_day")))
    file = F.pmod(F.xxhash64(*df.columns), F.col("_files")).alias("_file")
    arrays = dealt.groupBy("_day", file).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    rows = arrays.select("value", F.col("_day").cast("string").alias("d"))
    rows.write.option("maxRecordsPerFile", 1).partitionBy("d").text(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of files that each hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def file_lineage(spark: SparkSession, path: str, schema: StructType, pattern: str | None = None) -> DataFrame:
    """Files under a prefix with their record counts, by directory relative to it."""
    reader = spark.read.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.json(path).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("n_records")
    )
    relative = F.substring_index(F.col("file_path"), f"{path.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    return files.withColumn("directory", F.regexp_replace(relative, r"/?[^/]*$", ""))


def _store_of(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, on whatever store it names."""
    store, where = _store_of(spark, path)
    return store.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a directory on whatever store the path names."""
    store, where = _store_of(spark, path)
    store.delete(where, True)
