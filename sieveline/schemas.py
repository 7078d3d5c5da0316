"""Relations of the data model as Spark schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(fields: str) -> StructType:
    """Schema of "name type, name type"; unlike fromDDL it needs no running session."""
    pairs = [field.split() for field in fields.split(", ")]
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES: dict[str, StructType] = {
    "pipeline_runs": _schema(
        "run_id string, source string, run_at timestamp, records bigint, status string, error string"
    ),
    "gate_results": _schema(
        "record_id string, source string, checked_at timestamp, passed boolean, failure_code string, explanation string"
    ),
    "source_status": _schema(
        "source string, updated_at timestamp, trust_score double, is_blocked boolean, block_reason string"
    ),
    "bronze_stocks": _schema(
        "ticker string, date date, open double, high double, low double, close double, volume bigint, "
        "ingested_at timestamp, source_file string"
    ),
    "bronze_news": _schema(
        "article_id string, title string, description string, url string, published_at timestamp, "
        "source_name string, ingested_at timestamp"
    ),
    "bronze_macro": _schema("series_id string, date date, value double, ingested_at timestamp"),
    # Keyed, so that a release already verified is found as a duplicate.
    "bronze_releases": _schema(
        "release_id string, title string, url string, scraped_at timestamp, source string, ingested_at timestamp"
    ),
    "bronze_reddit": _schema(
        "post_id string, subreddit string, title string, score int, num_comments int, upvote_ratio double, "
        "created_utc timestamp, body_snippet string, ingested_at timestamp"
    ),
    "quarantine_log": _schema(
        "record_id string, source string, quarantined_at timestamp, failure_code string, failure_detail string, "
        "explanation string, raw_record string"
    ),
    "enriched_news": _schema(
        "article_id string, sentiment string, confidence double, tickers_mentioned array<string>, "
        "topic_tags array<string>, market_implication string, enriched_at timestamp"
    ),
    "stock_anomalies": _schema(
        "anomaly_id string, ticker string, date date, close double, avg_close_30d double, pct_change double, "
        "std_devs double, explanation string, detected_at timestamp"
    ),
    "live_ticks": _schema(
        "event_id string, ticker string, bar_timestamp timestamp, polled_at timestamp, open double, high double, "
        "low double, close double, volume bigint, gate_passed boolean, received_at timestamp"
    ),
    "stream_quarantine": _schema(
        "event_id string, ticker string, failure_code string, failure_detail string, raw_event string, "
        "quarantined_at timestamp"
    ),
}

KEYS: dict[str, tuple[str, ...]] = {
    "pipeline_runs": ("run_id",),
    "gate_results": ("record_id",),
    "source_status": ("source",),
    "bronze_stocks": ("ticker", "date"),
    "bronze_news": ("article_id",),
    "bronze_releases": ("release_id",),
    "bronze_reddit": ("post_id",),
    "quarantine_log": ("record_id",),
    "enriched_news": ("article_id",),
    "stock_anomalies": ("anomaly_id",),
    "live_ticks": ("event_id",),
    "stream_quarantine": ("event_id",),
}

# Records as they arrive, before any check. Prices and volume of bars and ticks are
# read as text so that a wrong type becomes a gate failure instead of a silent null.
RAW: dict[str, StructType] = {
    "stocks": _schema(
        "ticker string, ticker_clean string, date string, open string, high string, low string, close string, "
        "volume string, ingested_at string, source string, exchange string, _corrupt_record string"
    ),
    "news": _schema(
        "article_id string, title string, description string, url string, published_at string, source_name string, "
        "ingested_at string, _corrupt_record string"
    ),
    "macro": _schema(
        "release_id string, title string, url string, scraped_at string, source string, _corrupt_record string"
    ),
    "reddit": _schema(
        "post_id string, subreddit string, title string, score string, num_comments string, upvote_ratio string, "
        "created_utc string, body_snippet string, ingested_at string, source string, _corrupt_record string"
    ),
    "ticks": _schema(
        "event_id string, poll_id string, ticker string, timestamp string, polled_at string, open string, "
        "high string, low string, close string, volume string, source string, _corrupt_record string"
    ),
}


def extended(schema: StructType, ddl: str) -> StructType:
    """A copy of a schema with more fields."""
    return StructType([*schema.fields, *_schema(ddl).fields])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """The table with no rows: what a first run sees where nothing is stored yet."""
    return spark.createDataFrame([], TABLES[table])
