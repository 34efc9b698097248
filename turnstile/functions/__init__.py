"""Column expressions shared by the operators."""

from turnstile.functions.timecols import (
    clock_label,
    local_hour,
    local_time,
    minutes_between,
    period_rank,
    record_date,
    record_hour,
    time_period,
    ts_cutoff,
    ts_literal,
)

__all__ = [
    "clock_label",
    "local_hour",
    "local_time",
    "minutes_between",
    "period_rank",
    "record_date",
    "record_hour",
    "time_period",
    "ts_cutoff",
    "ts_literal",
]
