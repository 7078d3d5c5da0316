"""Quality rules: the first one a record breaks.

A rule is (condition, code, detail). All conditions become one CASE that yields the
number of the first broken rule; code and detail are then picked by that number, so
later conditions and the texts of other rules are not evaluated.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StructType, TimestampNTZType, TimestampType

from sieveline import config as C

# Accepted timestamp shape (full date first) and a title of white space only.
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
ISO_ZONE = r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$"
DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
BLANK = r"(?U)^[\s\x1c-\x1f]*$"

_TEMPORAL = (DateType, TimestampType, TimestampNTZType)


def as_time(moment: datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else F.lit(moment)


def span(length: timedelta) -> Column:
    return F.make_dt_interval(secs=F.lit(length.total_seconds()))


def describe_span(length: timedelta) -> str:
    hours, rest = divmod(int(length.total_seconds()), 3600)
    if rest:
        return f"{int(length.total_seconds()) // 60} minutes"
    return f"{hours // 24} days" if hours % 24 == 0 else f"{hours} hours"


def number(name: str, kind: DataType) -> Column:
    """The field as a double; null where it holds no number."""
    column = F.col(name)
    return column.cast("double") if isinstance(kind, NumericType) else column.try_cast("double")


def utc_day(moment: Column) -> Column:
    """The UTC day of a timestamp, whatever the session's zone."""
    return F.to_date(F.to_utc_timestamp(moment, F.current_timezone()))


def event_time(name: str, kind: DataType, date_only: bool = False) -> Column:
    """The record's own time in UTC; null where it cannot be read.

    Text and times without a zone are UTC, whatever the session's zone.
    """
    column = F.col(name)
    if isinstance(kind, TimestampType):
        return column
    if date_only and not isinstance(kind, _TEMPORAL):
        column = F.when(column.rlike(DATE_SHAPE), column.try_cast("date"))
    if date_only or isinstance(kind, _TEMPORAL):
        return F.from_utc_timestamp(column.cast("timestamp"), F.current_timezone())
    naive = F.when(F.length(column) == 10, F.concat(column, F.lit("T00:00:00Z"))).otherwise(F.concat(column, F.lit("Z")))
    zoned = F.when(column.rlike(ISO_ZONE), column).otherwise(naive)
    return F.when(column.rlike(ISO_SHAPE), F.try_to_timestamp(zoned))


# Condition, failure code, detail; condition and detail are SQL expressions.
Rule = tuple[str, str, str]


def _shown(name: str) -> str:
    return f"coalesce(cast(`{name}` as string), 'null')"


def _typed(name: str) -> str:
    """The field as read by ``_read``: a double, or a time."""
    return f"`_typed_{name}`"


def _text(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def _numeric_fields(rules: C.SourceRules, schema: StructType) -> list[str]:
    names = [*rules.prices, *([rules.volume] if rules.volume else []), *rules.numbers]
    return [f for f in names if f in schema.fieldNames()]


def _read(df: DataFrame, rules: C.SourceRules, as_of: datetime | Column) -> DataFrame:
    """Add each checked field once in its type, and the check time, for all rules."""
    schema = df.schema
    typed = {f"_typed_{f}": number(f, schema[f].dataType) for f in _numeric_fields(rules, schema)}
    if rules.time_field in schema.fieldNames():
        kind = schema[rules.time_field].dataType
        typed[f"_typed_{rules.time_field}"] = event_time(rules.time_field, kind, rules.date_only)
        now = as_time(as_of)
        typed["_oldest"] = now - span(rules.max_age)
        typed["_newest"] = now + span(rules.max_ahead)
    return df.withColumns(typed)


def missing_fields(rules: C.SourceRules, schema: StructType) -> Rule:
    null = {f: f"`{f}` is null" if f in schema.fieldNames() else "true" for f in rules.required}
    names = ", ".join(f"case when {test} then '{f}' end" for f, test in null.items())
    return " or ".join(null.values()), C.SCHEMA_MISSING_FIELD, _text("'missing fields: '", f"concat_ws(', ', {names})")


def wrong_types(rules: C.SourceRules, schema: StructType) -> list[Rule]:
    """Prices and volume that are present but hold no number; fields typed as numbers cannot."""
    tests = {
        f: f"{_typed(f)} is null"
        for f in _numeric_fields(rules, schema)
        if f not in rules.numbers and not isinstance(schema[f].dataType, NumericType)
    }
    if not tests:
        return []
    names = ", ".join(f"case when {test} then {_text(repr(f + '='), _shown(f))} end" for f, test in tests.items())
    return [
        (" or ".join(tests.values()), C.SCHEMA_WRONG_TYPE, _text("'not a number: '", f"concat_ws(', ', {names})"))
    ]


def range_rules(rules: C.SourceRules, schema: StructType) -> list[Rule]:
    """Plausibility rules in the order they are reported.

    NaN compares as the largest double in Spark, so it needs its own test.
    """
    held = set(_numeric_fields(rules, schema))
    out: list[tuple[str, str]] = []
    for f in rules.prices:
        if f in held:
            out.append(
                (
                    f"{_typed(f)} <= 0 or isnan({_typed(f)})",
                    _text(f"'{f}='", _shown(f), "' is not a price above zero'"),
                )
            )
    if rules.volume in held:
        f = rules.volume
        out.append((f"{_typed(f)} < 0 or isnan({_typed(f)})", _text(f"'{f}='", _shown(f), "' is negative'")))
    if {"high", "low"} <= held:
        out.append(
            (
                f"{_typed('high')} < {_typed('low')}",
                _text("'high='", _shown("high"), "' is below low='", _shown("low")),
            )
        )
    if rules.max_move_pct is not None:
        opened, closed = _typed("open"), _typed("close")
        out.append(
            (
                f"{opened} > 0 and abs(try_divide({closed} - {opened}, {opened})) * 100 > {rules.max_move_pct}D",
                _text(
                    "'open='", _shown("open"), "' to close='", _shown("close"),
                    f"' moves more than {rules.max_move_pct:g}% in one bar'",
                ),
            )
        )
    for f in rules.texts:
        if f in schema.fieldNames():
            out.append((f"`{f}` rlike r'{BLANK}'", f"'{f} is blank'"))
    for f in rules.numbers:
        if f in held:
            out.append(
                (f"`{f}` is not null and {_typed(f)} is null", _text(f"'{f}='", _shown(f), "' is not numeric'"))
            )
    return [(condition, C.RANGE_VIOLATION, detail) for condition, detail in out]


def freshness_rules(rules: C.SourceRules, schema: StructType) -> list[Rule]:
    """Unreadable, too old, too far ahead; both limits themselves still pass."""
    f = rules.time_field
    if f not in schema.fieldNames():
        return []
    limits = [
        (f"{_typed(f)} is null", " is not a readable time"),
        (f"{_typed(f)} < _oldest", f" is older than {describe_span(rules.max_age)}"),
        (f"{_typed(f)} > _newest", f" is more than {describe_span(rules.max_ahead)} in the future"),
    ]
    return [(condition, C.STALE, _text(f"'{f}='", _shown(f), f"'{text}'")) for condition, text in limits]


def with_failure(df: DataFrame, rules: C.SourceRules, as_of: datetime | Column) -> DataFrame:
    """Add ``failure_code`` and ``failure_detail`` of the first broken rule (null = clean).

    Order: missing fields, wrong types, ranges, freshness. No shuffle.
    """
    schema = df.schema
    chain = [
        missing_fields(rules, schema),
        *wrong_types(rules, schema),
        *range_rules(rules, schema),
        *freshness_rules(rules, schema),
    ]
    cases = " ".join(f"when {condition} then {i}" for i, (condition, _, _) in enumerate(chain, start=1))
    # Exploding the one number makes it a column of its own: a later filter on the code
    # tests that column instead of repeating the whole CASE.
    numbered = _read(df, rules, as_of).selectExpr("*", f"explode(array(case {cases} end)) as _rule")
    codes = ", ".join(f"'{code}'" for _, code, _ in chain)
    details = ", ".join(detail for _, _, detail in chain)
    return numbered.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"elt(_rule, {codes}) as failure_code",
        f"elt(_rule, {details}) as failure_detail",
    )
