"""The batch quality gate.

Row rules need no shuffle. Only records that pass them meet the one expensive
check, the lookup of their key among verified records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StructType

from sieveline import config as C
from sieveline.functions import rules as R


def check(df: DataFrame, rules: C.SourceRules, as_of: datetime | Column) -> DataFrame:
    """Add ``failure_code`` and ``failure_detail`` from the row rules (null = clean)."""
    return R.with_failure(df, rules, as_of)


def _key_columns(rules: C.SourceRules, raw: StructType, stored: StructType | None) -> dict[str, Column]:
    """Raw key fields in the type the store holds, so '2026-6-3' meets DATE '2026-06-03'."""
    out = {}
    for i, name in enumerate(rules.key):
        own_time = name == rules.time_field and rules.date_only
        kind = stored[name].dataType if stored else DateType() if own_time else raw[name].dataType
        if own_time and isinstance(kind, DateType):
            out[f"_key{i}"] = R.utc_day(R.event_time(name, raw[name].dataType, rules.date_only))
        else:
            out[f"_key{i}"] = F.col(name).try_cast(kind)
    return out


def _reachable(verified: DataFrame, rules: C.SourceRules, as_of: datetime | Column) -> DataFrame:
    """Drop verified keys no fresh record can have.

    Where the key holds the record's own date and the check time is a constant,
    fresh records lie in a few known days. On a store partitioned by that date
    this reads those partitions only.
    """
    field = rules.time_field
    if isinstance(as_of, Column) or field not in rules.key or not isinstance(verified.schema[field].dataType, DateType):
        return verified
    # One more day on each side covers the time of day and any zone of ``as_of``.
    first = (as_of - rules.max_age - timedelta(days=1)).date()
    last = (as_of + rules.max_ahead + timedelta(days=1)).date()
    return verified.filter(F.col(field).between(F.lit(first), F.lit(last)))


def _repeats(clean: DataFrame, keys: list[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """(first copies, later copies) within one batch; ``seq`` is unique per record.

    The lowest ``seq`` per key comes from a map-side combined aggregate. Joining on
    key and ``seq`` together spreads the copies of a hot key over all tasks.
    """
    first = clean.groupBy(*keys).agg(F.min(seq).alias(seq))
    on = [*keys, seq]
    return clean.join(first, on, "left_semi"), clean.join(first, on, "left_anti")


def gate(
    df: DataFrame,
    rules: C.SourceRules,
    as_of: datetime | Column,
    verified: DataFrame | None = None,
    verified_unique: bool = False,
    intra_batch: str | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """Every input record once, with ``passed``, ``failure_code``, ``failure_detail``.

    ``verified`` holds records accepted before; none means nothing is a duplicate. Say
    ``verified_unique`` where it has one row per key, as a compacted store does: the
    lookup is then one left join in one pass over the records. The promise is checked on the
    keys and a broken one raises, since the join would multiply records; that is a pass over the
    store's keys, which ``check_unique=False`` saves where the store itself keeps it. Without it the lookup
    is a semi and an anti join, which cannot. Adaptive execution can
    split a hot key on the record side in either case, since nothing is aggregated
    between shuffle and join.

    Copies inside the batch all pass unless ``intra_batch`` names a column that is
    unique per record: then only the copy with the lowest value passes.
    """
    checked = check(df, rules, as_of)
    keys = [f"_key{i}" for i in range(len(rules.key))]
    if verified is not None:
        known = _reachable(verified, rules, as_of).select(
            *[F.col(name).alias(key) for name, key in zip(rules.key, keys)]
        )
        keyed = checked.withColumns(_key_columns(rules, df.schema, verified.schema))
        if verified_unique and check_unique and known.groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError(f"the verified records of {rules.source} repeat a key")
        lookup = _lookup_once if verified_unique else _lookup_any
        checked = lookup(keyed, known, keys, rules).drop(*keys)
    if intra_batch is not None:
        keyed = checked.withColumns(_key_columns(rules, df.schema, verified.schema if verified is not None else None))
        # A record without a full key equals no other one, so it is nobody's copy.
        searchable = F.col("failure_code").isNull()
        for key in keys:
            searchable = searchable & F.col(key).isNotNull()
        first, later = _repeats(keyed.filter(searchable), keys, intra_batch)
        later = later.withColumns(_duplicate(rules, "repeats in this batch"))
        checked = keyed.filter(~searchable).unionByName(first).unionByName(later).drop(*keys)
    return checked.withColumn("passed", F.col("failure_code").isNull()).select(
        *df.columns, "failure_code", "failure_detail", "passed"
    )


def _duplicate(rules: C.SourceRules, detail: str) -> dict[str, Column]:
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in rules.key])
    return {"failure_code": F.lit(C.DUPLICATE), "failure_detail": F.concat(shown, F.lit(f" {detail}"))}


def _lookup_once(keyed: DataFrame, known: DataFrame, keys: list[str], rules: C.SourceRules) -> DataFrame:
    """Mark clean records whose key is known; each key occurs once in ``known``.

    Failed records take part only through the join condition, so they match nothing.
    """
    left, right = keyed.alias("record"), known.withColumn("_known", F.lit(True)).alias("known")
    on = F.col("record.failure_code").isNull()
    for key in keys:
        on = on & (F.col(f"record.{key}") == F.col(f"known.{key}"))
    joined = left.join(right, on, "left")
    marks = _duplicate(rules, "is already verified")
    kept = [F.col(f"record.{c}").alias(c) for c in keyed.columns if c not in marks]
    decided = [
        F.when(F.col("known._known"), mark).otherwise(F.col(f"record.{name}")).alias(name)
        for name, mark in marks.items()
    ]
    return joined.select(*kept, *decided)


def _lookup_any(keyed: DataFrame, known: DataFrame, keys: list[str], rules: C.SourceRules) -> DataFrame:
    """The same where ``known`` may repeat keys.

    Both joins read the same two shuffles. For that their inputs must be equal: records
    without a full key, which match nothing, are set aside beforehand, and the verdict
    columns, empty for clean records, are added after the joins.
    """
    verdict = ["failure_code", "failure_detail"]
    searchable = F.col("failure_code").isNull()
    for key in keys:
        searchable = searchable & F.col(key).isNotNull()
    clean = keyed.filter(searchable).drop(*verdict)
    repeated = clean.join(known, keys, "left_semi").withColumns(_duplicate(rules, "is already verified"))
    new = clean.join(known, keys, "left_anti").withColumns({c: F.lit(None).cast("string") for c in verdict})
    return keyed.filter(~searchable).unionByName(repeated).unionByName(new)


def raw_json(columns: list[str]) -> Column:
    """The record as received, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def record_id(rules: C.SourceRules, raw: Column, seq: str | None = None) -> Column:
    """Content hash: a retry of the same batch gives the same identifier.

    ``seq`` tells byte-identical copies apart, which a content hash alone cannot.
    """
    parts = [F.lit(rules.source), raw]
    if seq is not None:
        parts.append(F.col(seq).cast("string"))
    return F.sha2(F.concat_ws("|", *parts), 256)


def identify(gated: DataFrame, rules: C.SourceRules, record: list[str], seq: str | None = None) -> DataFrame:
    """Add ``raw_record`` and ``record_id`` to gated records; ``record`` lists the received fields.

    Only a failed record keeps its text: a passed one is stored in its own columns.
    """
    raw = raw_json(record)
    return gated.withColumns(
        {"raw_record": F.when(~F.col("passed"), raw), "record_id": record_id(rules, raw, seq)}
    )


def gate_log(identified: DataFrame, rules: C.SourceRules, checked_at: datetime | Column) -> DataFrame:
    """One row per decision, in the shape of ``gate_results``."""
    return identified.select(
        "record_id",
        F.lit(rules.source).alias("source"),
        R.as_time(checked_at).alias("checked_at"),
        "passed",
        "failure_code",
        F.lit(None).cast("string").alias("explanation"),
    )


def quarantine_log(identified: DataFrame, rules: C.SourceRules, quarantined_at: datetime | Column) -> DataFrame:
    """Failed records with code, detail and the record as received."""
    return identified.filter(~F.col("passed")).select(
        "record_id",
        F.lit(rules.source).alias("source"),
        R.as_time(quarantined_at).alias("quarantined_at"),
        "failure_code",
        "failure_detail",
        F.lit(None).cast("string").alias("explanation"),
        "raw_record",
    )


def passed_records(gated: DataFrame, record: list[str]) -> DataFrame:
    """The verified route: clean records in their received shape."""
    return gated.filter("passed").select(*record)


def failed_records(gated: DataFrame, record: list[str]) -> DataFrame:
    """The quarantine route: received fields plus ``_failure_code`` and ``_failure_detail``."""
    return gated.filter(~F.col("passed")).select(
        *record,
        F.col("failure_code").alias("_failure_code"),
        F.col("failure_detail").alias("_failure_detail"),
    )


def summary(gated: DataFrame, source: str | Column) -> DataFrame:
    """Total, passed and failed counts per source."""
    name = source if isinstance(source, Column) else F.lit(source)
    return gated.groupBy(name.alias("source")).agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def _fitted(value: Column, kind: DataType) -> Column:
    """The value in a table's type; whole-number columns also take text such as '10.0'."""
    fitted = value.try_cast(kind)
    return F.coalesce(fitted, value.try_cast("double").try_cast(kind)) if isinstance(kind, IntegralType) else fitted


def verified_rows(
    passed: DataFrame, table: StructType, renamed: Mapping[str, Column] | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Map passed records to a verified table's columns and types; absent fields are null. ``extra`` columns stay as they are."""
    renamed = renamed or {}
    columns = []
    for field in table:
        if field.name in renamed:
            value = _fitted(renamed[field.name], field.dataType)
        elif field.name in passed.columns:
            value = _fitted(F.col(field.name), field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return passed.select(*columns, *extra)
