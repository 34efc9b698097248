"""The four reports over clean events, in the whole-history ("full") and latest-day ("daily")
variants. Every report is a partial + final hash aggregation or one pairing pass; the final
``orderBy`` only sorts the (small) aggregated result, except for durations (one row per stay,
a range-partitioned distributed sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import minutes_between, record_hour
from turnstile.operators.pairing import pair_entries
from turnstile.operators.quality import with_record_date
from turnstile.schema import ENTRY, EXIT, MAIN_GATE, ROOM_GATE

def _is_main():
    return F.col("gate_type") == MAIN_GATE


def _is_room():
    return F.col("gate_type") == ROOM_GATE


def _is_entry():
    return F.col("event_type") == ENTRY


def _is_exit():
    return F.col("event_type") == EXIT



def _n(cond):
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


# -- hourly main-gate traffic -------------------------------------------------------------

def hourly_gate_traffic_full(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Entries and exits per (date, hour) at the main gate; an hour with exits only has 0 entries."""
    out = (
        with_record_date(clean)
        .filter(_is_main())
        .groupBy("record_date", record_hour("timestamp").alias("record_hour"))
        .agg(_n(_is_entry()).alias("total_hourly_entries"), _n(_is_exit()).alias("total_hourly_exits"))
    )
    return out.orderBy("record_date", "record_hour") if ordered else out


def hourly_gate_traffic_daily(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Main-gate entries per (date, hour); hours without entries are absent."""
    out = (
        with_record_date(clean)
        .filter(_is_main() & _is_entry())
        .groupBy("record_date", record_hour("timestamp").alias("record_hour"))
        .agg(F.count("event_id").alias("total_hourly_entries"))
    )
    return out.orderBy("record_date", "record_hour") if ordered else out


# -- daily room usage (same in both variants) --------------------------------------------

def daily_room_usage(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Room entries per (date, room), busiest room first within a date."""
    out = (
        with_record_date(clean)
        .filter(_is_room() & _is_entry())
        .groupBy("record_date", "location")
        .agg(F.count("event_id").alias("total_room_entries"))
    )
    if not ordered:
        return out
    return out.orderBy(
        F.col("record_date").asc_nulls_first(),
        F.col("total_room_entries").desc(),
        F.col("location").asc_nulls_last(),
    )


daily_room_usage_full = daily_room_usage
daily_room_usage_daily = daily_room_usage


# -- hourly room usage --------------------------------------------------------------------

def hourly_room_usage_full(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Room entries and exits per (date, room, hour)."""
    out = (
        with_record_date(clean)
        .filter(_is_room())
        .groupBy("record_date", "location", record_hour("timestamp").alias("record_hour"))
        .agg(_n(_is_entry()).alias("total_entries"), _n(_is_exit()).alias("total_exits"))
        .select(
            "record_date",
            F.col("location").alias("room_id"),
            "record_hour",
            "total_entries",
            "total_exits",
        )
    )
    return out.orderBy("record_date", "room_id", "record_hour") if ordered else out


def hourly_room_usage_daily(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Room visits (entries with a student) per (date, room, entry hour)."""
    out = (
        with_record_date(clean)
        .filter(_is_room() & _is_entry())
        .groupBy("record_date", "location", record_hour("timestamp").alias("entry_hour"))
        .agg(F.count("student_id").alias("total_visits"))
        .select(
            "record_date",
            F.col("location").alias("room_id"),
            "entry_hour",
            "total_visits",
        )
    )
    return out.orderBy("record_date", "room_id", "entry_hour") if ordered else out


# -- room stay durations ------------------------------------------------------------------

def room_durations(
    clean: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """One row per room stay: a room ENTRY directly followed (per student and room) by an
    EXIT. Dated by the entry; minutes between the whole seconds, 2 decimals.

    On whole-history input a stay may pass midnight; on one day's input it cannot (its
    other half is outside the day), which is the difference between the two variants.
    """
    stays = pair_entries(
        with_record_date(clean).filter(_is_room()),
        keys=("student_id", "location"),
        extra=("record_date",),
    )
    out = stays.select(
        "record_date",
        F.col("location").alias("room_id"),
        "student_id",
        F.col("timestamp").alias("entry_time"),
        F.col("exit_timestamp").alias("exit_time"),
        minutes_between("timestamp", "exit_timestamp").alias("occupied_minutes"),
    )
    if ordered:
        out = out.orderBy("record_date", "room_id", "entry_time", "student_id")
    return out


room_durations_full = room_durations
room_durations_daily = room_durations
