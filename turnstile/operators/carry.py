"""Stays across runs: days are paired one after the other, with the entries that were still open before them.

An entry that no later event of its (student, room) follows is *open*. The open entries at the end of a day are all that later days
need of the earlier ones: a day's events and the open entries before it give exactly the stays that end on that day, also
those that began earlier. They come from one row a day and key (its last event), whatever the number of events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import minutes_between, record_date
from turnstile.operators.pairing import pair_entries
from turnstile.operators.quality import with_record_date
from turnstile.schema import ENTRY, ROOM_GATE

KEYS = ("student_id", "location")
#: An open entry: the event, its day, and the day at whose end it is open.
OPEN = ("student_id", "location", "record_date", "timestamp", "event_id")


def room_events(clean: DataFrame) -> DataFrame:
    return with_record_date(clean).filter(F.col("gate_type") == ROOM_GATE).select(*OPEN, "event_type")


def with_open(clean: DataFrame, before: DataFrame | None) -> DataFrame:
    """Room events, and the entries open before them."""
    events = room_events(clean)
    return events if before is None else events.unionByName(before.select(*OPEN, F.lit(ENTRY).alias("event_type")))


def closed_stays(clean: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The stays that end within the days of ``clean``, in the columns of the report, and ``closed_date``."""
    stays = pair_entries(with_open(clean, before), keys=KEYS, extra=("record_date",))
    return stays.select(
        "record_date",
        F.col("location").alias("room_id"),
        "student_id",
        F.col("timestamp").alias("entry_time"),
        F.col("exit_timestamp").alias("exit_time"),
        minutes_between("timestamp", "exit_timestamp").alias("occupied_minutes"),
        record_date("exit_timestamp").alias("closed_date"),
    )


def open_entries(clean: DataFrame, before: DataFrame | None, days: list[dt.date]) -> DataFrame:
    """For each of ``days`` (the days of ``clean``, or some of them) the entries open at its end, as ``open_date``."""
    last = F.max(F.struct("timestamp", "event_id", "event_type")).alias("_last")
    edges = with_open(clean, before).groupBy(*KEYS, "record_date").agg(last)
    until = F.lead("record_date").over(Window.partitionBy(*KEYS).orderBy("record_date"))
    listed = F.array(*[F.lit(d) for d in days]) if days else F.array().cast("array<date>")
    held = edges.withColumn("_until", until).filter(F.col("_last.event_type") == ENTRY)
    open_on = F.filter(listed, lambda d: (d >= F.col("record_date")) & (F.col("_until").isNull() | (d < F.col("_until"))))
    return held.select(*KEYS, "record_date", "_last.timestamp", "_last.event_id", F.explode(open_on).alias("open_date"))
