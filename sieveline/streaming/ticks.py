"""The gate on a stream of tick events.

Stateless per event: decode, check, tag. Each micro-batch is written as one directory
named after its batch id and split by verdict, so a batch that is run again after a
failure replaces itself and readers never see an event twice. While a batch is being
replaced its directory is incomplete for readers. ``compact`` folds closed batches into a
keyed table partitioned by date and removes their directories. ``start_live`` keeps the table of live ticks itself,
with bounded state for copies.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from sieveline import config as C, schemas
from sieveline.functions import rules as R
from sieveline.operators.dedupe import upsert_latest
from sieveline.session import scratch_dir
from sieveline.sources import tables
from sieveline.sources.snapshots import even_files, remove

RULES = C.RULES["ticks"]
PLACE = "_place"
EVENT_FIELDS = [f.name for f in schemas.RAW["ticks"] if f.name != "_corrupt_record"]


def read_kafka(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Messages of a topic from the earliest offset; the checkpoint keeps the position.

    Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset",
    )


def read_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same messages from JSON-line files; the file stands for the topic.

    A line's offset is its number in the file. It follows from where its block starts in the file once a batch is
    there (``line_numbers``), so equal lines are events of their own and keep their identifiers when a batch is read again.
    """
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(
        F.lit(None).cast("string").alias("key"), "value", F.col("_metadata.file_path").alias("topic"),
        F.lit(0).alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def line_numbers(messages: DataFrame) -> DataFrame:
    """Sets ``offset`` of lines that have none to their number in the file (``topic``), counted from 0.

    Spark reads a block of a file in one task and in order, so a line's place in its block is the difference of two
    running numbers; the lines of the blocks before it are counted and summed per file, one row per block. The result does
    not depend on how files are cut into blocks. A column ``_place`` with the running numbers is taken as it is, so that they
    can be stored with the lines. Identifiers that hang on the offset are filled in as well.
    """
    columns = [c for c in messages.columns if c != PLACE]
    placed = messages if PLACE in messages.columns else messages.withColumn(PLACE, F.monotonically_increasing_id())
    blocks = placed.groupBy("topic", "block").agg(F.min(PLACE).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("topic").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    numbered = placed.join(blocks, ["topic", "block"]).withColumn(
        "offset", F.coalesce("offset", F.col("_before") + F.col(PLACE) - F.col("_first"))
    )
    if "event_id" in messages.columns:
        numbered = numbered.withColumn("event_id", F.coalesce("event_id", position_id()))
    return numbered.select(*columns)


def position_id() -> Column:
    """Identifier of a message that carries none: the hash of its position; null without an offset."""
    position = F.sha2(F.concat_ws("|", "topic", "partition", "offset", "value"), 256)
    return F.when(F.col("offset").isNotNull(), position)


def decode(messages: DataFrame) -> DataFrame:
    """Message fields plus the event's fields; text that is no JSON object stays in
    ``_corrupt_record`` with every field null.

    The text is parsed by a generator, once per message: fields of a parsed struct would
    each bring their own copy of the parse into later filters.
    """
    parsed = F.from_json(
        "value", schemas.RAW["ticks"], {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return messages.select(*messages.columns, F.inline(F.array(parsed)))


def gate_ticks(events: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Add the verdict. The rules have no duplicate check: repeats are settled by the
    keyed tables. The same rules serve batch and stream."""
    return R.with_failure(events, RULES, as_of).withColumn("gate_passed", F.col("failure_code").isNull())


def tag(gated: DataFrame, received_at: Column) -> DataFrame:
    """Symbol from key, else event, else "unknown"; an event without an identifier gets the hash of its
    position, lines of files once they are numbered, others without an offset a random one; time of receipt."""
    later = F.lit(None).cast("string") if "block" in gated.columns else F.uuid()
    return gated.withColumns(
        {
            "ticker": F.coalesce("key", "ticker", F.lit("unknown")),
            "event_id": F.coalesce("event_id", position_id(), later),
            "received_at": received_at.cast("timestamp"),
        }
    )


def process(messages: DataFrame, as_of: datetime | Column, received_at: Column | None = None) -> DataFrame:
    """Decode, gate and tag, in one stage without a shuffle."""
    return tag(gate_ticks(decode(messages), as_of), received_at if received_at is not None else R.as_time(as_of))


def counts(processed: DataFrame) -> DataFrame:
    """Passed, failed and total events."""
    return processed.agg(
        F.count_if("gate_passed").alias("passed"),
        F.count_if(~F.col("gate_passed")).alias("failed"),
        F.count("*").alias("total"),
    )


def observed(processed: DataFrame, name: str = "gate_counts") -> DataFrame:
    """The same counts as metrics of every micro-batch, in the query's progress."""
    return processed.observe(
        name,
        F.count_if("gate_passed").alias("passed"),
        F.count_if(~F.col("gate_passed")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def live_rows(processed: DataFrame, *extra: Column) -> DataFrame:
    """Verified events in the shape of ``live_ticks``, and what ``extra`` adds."""
    time = lambda name: F.when(F.col(name).rlike(R.ISO_SHAPE), F.try_to_timestamp(name))
    return processed.filter("gate_passed").select(
        "event_id",
        "ticker",
        time("timestamp").alias("bar_timestamp"),
        time("polled_at").alias("polled_at"),
        *[F.col(p).try_cast("double").alias(p) for p in ("open", "high", "low", "close")],
        F.col("volume").try_cast("double").try_cast("bigint").alias("volume"),
        "gate_passed",
        "received_at",
        *extra,
    )


def quarantine_rows(processed: DataFrame) -> DataFrame:
    """Failed events in the shape of ``stream_quarantine``; the raw text is the message."""
    return processed.filter(~F.col("gate_passed")).select(
        "event_id", "ticker", "failure_code", "failure_detail", F.col("value").alias("raw_event"),
        F.col("received_at").alias("quarantined_at"),
    )


def messages(processed: DataFrame) -> DataFrame:
    """Keyed messages for the routed topics: the message as received plus its verdict.

    The received JSON text is kept, so field types and unknown fields survive; the verdict's
    fields are appended and, being last, count where the event has fields of these names. Text
    that is no JSON object goes into ``raw_event``.
    """
    stamped = F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("received_at")
    own = F.when(F.get_json_object("value", "$.event_id").isNull(), F.col("event_id")).alias("event_id")
    passed = F.to_json(F.struct(own, "gate_passed", stamped))
    failed = F.to_json(F.struct(own, "gate_passed", "failure_code", "failure_detail", stamped))
    verdict = F.when(F.col("gate_passed"), passed).otherwise(failed)
    body = F.regexp_replace("value", r"(?s)\s*\}\s*$", "")
    comma = F.when(F.trim(body) == "{", F.lit("")).otherwise(F.lit(","))
    whole = F.col("_corrupt_record").isNull() & F.json_object_keys("value").isNotNull()
    raw = F.regexp_replace(F.to_json(F.struct(F.col("value").alias("raw_event"))), r"\}$", "")
    return processed.select(
        "gate_passed",
        F.col("ticker").alias("key"),
        F.when(whole, F.concat(body, comma, F.substring(verdict, 2, F.length(verdict))))
        .otherwise(F.concat(raw, F.lit(","), F.substring(verdict, 2, F.length(verdict))))
        .alias("value"),
    )


def send_kafka(rows: DataFrame, servers: str, verified_topic: str, quarantine_topic: str) -> None:
    """Route one batch of keyed messages by verdict; delivery is at least once."""
    topic = F.when(F.col("gate_passed"), verified_topic).otherwise(quarantine_topic).alias("topic")
    (
        rows.select("key", "value", topic)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .save()
    )


def start_gate(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    as_of: datetime | Column | None = None,
    received_at: Column | None = None,
    once: bool = False,
    interval: str = "5 seconds",
    kafka: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Gate a stream of messages into ``root/batch_id=N/gate_passed=...``.

    ``as_of`` is the batch's processing time unless given. ``once`` processes what is
    there and stops. ``kafka`` (servers, verified_topic, quarantine_topic) also routes
    each batch to topics, from the rows just stored.
    """
    now = as_of if as_of is not None else F.current_timestamp()
    processed = observed(process(stream, now, received_at))
    schema = processed.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        where = f"{root}/batch_id={batch_id}"
        aside = None
        if "block" in batch.columns:
            # Written once with its running numbers: numbering reads the lines twice, the batch must not run twice.
            aside = scratch_dir(batch.sparkSession, "lines")
            batch.withColumn(PLACE, F.monotonically_increasing_id()).write.parquet(aside)
            batch = line_numbers(batch.sparkSession.read.parquet(aside))
        batch.write.mode("overwrite").partitionBy("gate_passed").parquet(where)
        if aside:
            remove(batch.sparkSession, aside)
        if kafka:
            stored = batch.sparkSession.read.schema(schema).parquet(where)
            send_kafka(messages(stored), **kafka)

    writer = processed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.queryName(f"tick_gate_{checkpoint.rsplit('/', 1)[-1]}").start()


def stored(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """All gated events of a store; ``like`` is a frame of the processed shape."""
    return spark.read.schema(schemas.extended(like.schema, "batch_id bigint")).option("basePath", root).parquet(root)


# Last write wins: batches in order; within a batch the later time of receipt, then of the poll, then the later
# position; at last the text, so that the choice does not depend on how rows were read.
_SEQUENCE = ("batch_id", "received_at", "polled_at", "offset", "value")


def _sequenced(processed: DataFrame) -> DataFrame:
    return processed if "batch_id" in processed.columns else processed.withColumn("batch_id", F.lit(0).cast("bigint"))


def live_ticks(processed: DataFrame) -> DataFrame:
    """Verified events, the last written per event_id."""
    last = upsert_latest(_sequenced(processed).filter("gate_passed"), ["event_id"], _SEQUENCE)
    return live_rows(last)


def stream_quarantine(processed: DataFrame) -> DataFrame:
    """Failed events, the last written per event_id."""
    last = upsert_latest(_sequenced(processed).filter(~F.col("gate_passed")), ["event_id"], _SEQUENCE)
    return quarantine_rows(last)


def compact(
    spark: SparkSession, root: str, like: DataFrame, target: str, upto: int, earlier: str | None = None, remove_old: bool = False
) -> None:
    """The last write of each event in batches up to ``upto``, with the earlier compaction, as a table at ``target``.

    Partitioned by day of receipt. The path must be new: readers switch to it when it is complete, and read later
    batches with ``stored_since``. ``remove_old`` then deletes the folded batches' directories and the earlier compaction;
    without it they stay for readers at work. For a table that is merged as events come, see ``start_live``.
    """
    rows = stored(spark, root, like).filter(F.col("batch_id") <= upto)
    if earlier:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(earlier).drop("day"))
    last = upsert_latest(rows, ["event_id", "gate_passed"], _SEQUENCE).withColumn("day", R.utc_day(F.col("received_at")))
    even_files(last, ["day"]).write.mode("errorifexists").partitionBy("day").parquet(target)
    if remove_old:
        listed = spark.read.schema("batch_id bigint").option("basePath", root).parquet(root)
        for row in listed.filter(F.col("batch_id") <= upto).distinct().collect():
            remove(spark, f"{root}/batch_id={row.batch_id}")
        if earlier:
            remove(spark, earlier)


def stored_since(spark: SparkSession, root: str, like: DataFrame, compacted: str, upto: int) -> DataFrame:
    """All current events: the compacted table and the batches after it; older directories are pruned."""
    schema = schemas.extended(like.schema, "batch_id bigint")
    late = stored(spark, root, like).filter(F.col("batch_id") > upto)
    return spark.read.schema(schema).parquet(compacted).drop("day").unionByName(late)


def first_per_event(processed: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """First copy of each event on a stream, with state bounded by the watermark."""
    return processed.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["event_id"])


def last_writes(processed: DataFrame, delay: str = "30 minutes", span: str = "1 hour") -> DataFrame:
    """Verified events, the last received of each, with ``_written`` that later copies are compared by.

    On a stream this is keyed state: one row per event, kept until the watermark of the events' own time has passed its
    ``span`` by ``delay``. No event older than the gate's age limit passes, so a ``delay`` above that limit loses no
    copy. In update mode an event comes again when a copy arrives; a late or repeated copy brings the row it was.
    """
    order = F.struct(*_SEQUENCE[1:]).alias("_written")
    rows = live_rows(processed, order).withWatermark("bar_timestamp", delay)
    columns = [c for c in rows.columns if c != "_written"]
    kept = rows.groupBy("event_id", F.window("bar_timestamp", span).alias("_span")).agg(
        F.max_by(F.struct(*columns), "_written").alias("_row"), F.max("_written").alias("_written")
    )
    return kept.select("_row.*", "_written")


def start_live(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    as_of: datetime | Column | None = None,
    received_at: Column | None = None,
    delay: str = "30 minutes",
    once: bool = False,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Keeps ``root`` as the table of live ticks: one row per event, by day of its own time.

    Each micro-batch's changes are merged into the days they lie in, which are rewritten; other days are not touched and
    no directory stays behind per batch. A batch that runs again merges the same rows into the same result. Messages need an
    offset or an event_id (Kafka gives the first); lines of files without an event_id end the query, as they are numbered
    behind the stream only (``start_gate``).
    """
    processed = process(stream, as_of if as_of is not None else F.current_timestamp(), received_at)
    named = F.coalesce("event_id", F.raise_error(F.lit("a line of a file without event_id")).cast("string"))
    processed = processed.withColumn("event_id", named) if "block" in stream.columns else processed

    def store(batch: DataFrame, batch_id: int) -> None:
        changes = batch.withColumn("day", R.utc_day(F.col("bar_timestamp")))
        tables.merge_by_day(changes, root, ["event_id"], ["_written"])

    writer = last_writes(processed, delay).writeStream.outputMode("update").foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.queryName(f"live_{checkpoint.rsplit('/', 1)[-1]}").start()


def live_table(spark: SparkSession, root: str) -> DataFrame:
    """The table that ``start_live`` keeps; a filter on ``day`` prunes directories."""
    return spark.read.parquet(root).drop("_written")
