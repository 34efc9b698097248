"""Time expressions. All are built-in Catalyst expressions (codegen, no Python per row)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.schema import (
    CLOCK_AM_SUFFIX,
    CLOCK_MIDNIGHT,
    CLOCK_NOON,
    CLOCK_PM_SUFFIX,
    LOCAL_OFFSET_HOURS,
    NIGHT,
    PERIOD_ORDER,
    TIME_PERIODS,
)


def _as_text(value) -> str:
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:  # an instant with a zone: as UTC wall clock (session zone)
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, _dt.date):
        return value.strftime("%Y-%m-%d 00:00:00")
    return str(value)


def ts_literal(value, like: T.DataType | None = None) -> Column:
    """A timestamp literal of the same type as the column it is compared with, so the
    comparison needs no cast on the column side and stays a pushed Parquet filter."""
    text = F.lit(_as_text(value))
    if isinstance(like, T.TimestampNTZType):
        return text.cast("timestamp_ntz")
    return F.to_timestamp(text)


def _column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def ts_cutoff(df: DataFrame, name: str, as_of=None, minus_days: int = 0) -> Column:
    """``as_of - minus_days`` typed like ``df[name]``; ``as_of=None`` means now."""
    like = _column_type(df, name)
    if as_of is None:
        now = F.localtimestamp() if isinstance(like, T.TimestampNTZType) else F.current_timestamp()
        return now - F.make_dt_interval(F.lit(minus_days)) if minus_days else now
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return ts_literal(as_of - _dt.timedelta(days=minus_days), like)


def record_date(ts: str | Column = "timestamp") -> Column:
    return F.to_date(ts)


def record_hour(ts: str | Column = "timestamp") -> Column:
    return F.hour(ts)


def local_time(ts: str | Column = "timestamp", offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Shift by a fixed number of hours (the original reports local time as UTC+8)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return col + F.make_dt_interval(F.lit(0), F.lit(offset_hours))


def local_hour(ts: str | Column = "timestamp", offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return F.hour(local_time(ts, offset_hours))


def time_period(hour: Column) -> Column:
    """Morning 6-11, Afternoon 12-16, Evening 17-20, anything else (and null) Night."""
    expr = None
    for label, first, last in TIME_PERIODS:
        cond = hour.between(first, last)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(NIGHT)


def period_rank(period: Column) -> Column:
    expr = None
    for rank, label in enumerate(PERIOD_ORDER, start=1):
        expr = F.when(period == label, rank) if expr is None else expr.when(period == label, rank)
    return expr


def clock_label(hour: Column) -> Column:
    """12-hour clock text: 0 -> '12:00 AM', 1..11 -> 'h:00 AM', 12 -> '12:00 PM', else 'h-12:00 PM'."""
    return (
        F.when(hour == 0, F.lit(CLOCK_MIDNIGHT))
        .when(hour < 12, F.concat(hour.cast("string"), F.lit(CLOCK_AM_SUFFIX)))
        .when(hour == 12, F.lit(CLOCK_NOON))
        .otherwise(F.concat((hour - 12).cast("string"), F.lit(CLOCK_PM_SUFFIX)))
    )


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second difference in minutes, rounded to 2 decimals (seconds are floored first)."""
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60, 2)
