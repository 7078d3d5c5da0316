"""Exchange session predicates on UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sieveline import config as C


def _local(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), zone)


def _second_of_day(local: Column) -> Column:
    return F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)


def _clock(at: tuple[int, int]) -> int:
    return at[0] * 3600 + at[1] * 60


def in_session(
    ts: Column,
    zone: str = C.SESSION_ZONE,
    opens: tuple[int, int] = C.SESSION_OPEN,
    closes: tuple[int, int] = C.SESSION_CLOSE,
) -> Column:
    """Monday to Friday between open and close, both included to the second."""
    local = _local(ts, zone)
    return (F.weekday(local) < 5) & _second_of_day(local).between(_clock(opens), _clock(closes))


def next_session_open(
    ts: Column, zone: str = C.SESSION_ZONE, opens: tuple[int, int] = C.SESSION_OPEN
) -> Column:
    """UTC time of the next open. At or after today's open it is the next weekday's."""
    local = _local(ts, zone)
    day = F.weekday(local)
    ahead = (
        F.when((day < 5) & (_second_of_day(local) < _clock(opens)), 0)
        .when(day == 4, 3)
        .when(day == 5, 2)
        .otherwise(1)
    )
    midnight = F.date_add(F.to_date(local), ahead).cast("timestamp")
    return F.to_utc_timestamp(midnight + F.make_dt_interval(secs=F.lit(float(_clock(opens)))), zone)


def seconds_until_open(
    ts: Column, zone: str = C.SESSION_ZONE, opens: tuple[int, int] = C.SESSION_OPEN
) -> Column:
    """Whole seconds to the next open."""
    gap = F.unix_micros(next_session_open(ts, zone, opens)) - F.unix_micros(ts.cast("timestamp"))
    return F.floor(gap / 1_000_000).cast("bigint")
