"""Batch jobs: land the student file, the whole-history run, the latest-day run, analytics.

Each job reads tables, writes tables, and can be re-run: the output is the same.
Intermediate results that several outputs share (the clean events, the stays) are written
once as tables and read back, which also cuts the lineage a lost executor would replay. They
are read back with the schema they were written with, so that a table without rows is one too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.config import Settings
from turnstile.operators import analytics as A
from turnstile.operators import graph as G
from turnstile.operators import reports as R
from turnstile.operators.increments import due
from turnstile.operators.keys import FULL, index_rows, touched
from turnstile.operators.quality import (
    clean_events_daily,
    clean_events_full,
    latest_date,
    with_record_date,
)
from turnstile.schema import CLEAN_EVENT, STUDENT_DIM
from turnstile.sinks import preview, write_report, write_table
from turnstile.sources import latest_partition, read_curated, read_if_there, read_students_csv, read_table
from turnstile.streaming.ingest import STUDENT_SEEN


def land_students(spark: SparkSession, settings: Settings, csv_path: str | None = None) -> None:
    """Student CSV -> typed dimension table (replaced). A missing file is an error."""
    src = csv_path or settings.students_csv
    if not src:
        raise ValueError("no student file given")
    raw = read_students_csv(spark, src, unread=True)
    write_table(G.students_dim(raw), settings.students)
    write_table(G.rejected_students(raw), settings.students_rejects)


def students_table(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_table(spark, settings.students, STUDENT_DIM)


CLEAN_PARTITIONS = ("record_date", "gate_type")
CLEAN_CLUSTER = (*CLEAN_PARTITIONS, "timestamp", "event_id")
# Tables that increments carry from run to run (``turnstile.plans.increments``).
STAYS = (
    "record_date DATE, room_id STRING, student_id STRING, entry_time TIMESTAMP, exit_time TIMESTAMP, occupied_minutes DOUBLE, closed_date DATE"
)
OPEN_ENTRIES = (
    "student_id STRING, location STRING, record_date DATE, timestamp TIMESTAMP, event_id STRING, open_date DATE"
)
PENDING = T.StructType([*CLEAN_EVENT.fields, T.StructField("batch", T.StringType(), True)])
VISITS = (
    "visit_date DATE, local_date DATE, time_period STRING, major STRING, year INT, bucket BIGINT, visits BIGINT, students BINARY"
)
V_STUDENT = "student_id STRING, major STRING, year_of_study INT"
KEY_LAYOUT = {"partition_by": ("bucket", "batch"), "cluster_by": ("bucket", "event_id")}
# The event tables of the graph, by date, in the layout that the stream upsert appends to.
BY_DATE = ("v_event", "e_performed")


def keys_path(spark: SparkSession, settings: Settings) -> str:
    """The folder of the clean table's index of ids: the last that was folded (``increments.fold_keys``)."""
    folded = read_if_there(spark, f"{settings.clean_keys}_folded", "version INT")
    return f"{settings.clean_keys}/{max(touched(folded, 'version'), default=0):06d}"


def _publish(reports: dict[str, DataFrame], settings: Settings, show: bool = False, days: list | None = None) -> None:
    for name, df in reports.items():
        if show:
            preview(df, name)
        write_report(df, settings.report(name), days)


def _write_back(df: DataFrame, path: str) -> DataFrame:
    """Write clean events by date and gate, and read the table."""
    write_table(df, path, partition_by=CLEAN_PARTITIONS, cluster_by=CLEAN_CLUSTER)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_full_batch(
    spark: SparkSession, settings: Settings, as_of=None, with_graph: bool = True, show: bool = False
) -> None:
    """Whole history: clean table, four reports (replaced), graph tables (replaced)."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc)  # one time for the whole run
    curated = read_curated(spark, settings.curated)
    clean = _write_back(clean_events_full(curated, as_of=as_of), settings.clean)
    durations = R.room_durations_full(clean, ordered=False)
    _publish(
        {
            "hourly_traffic": R.hourly_gate_traffic_full(clean, ordered=False),
            "daily_rooms": R.daily_room_usage_full(clean, ordered=False),
            "hourly_room_usage": R.hourly_room_usage_full(clean, ordered=False),
            "room_durations": durations,
        },
        settings,
        show=show,
    )
    # For increments: which day holds each id, what has to wait for its time; what they carried over starts anew.
    write_table(index_rows(clean, FULL, settings.key_buckets), keys_path(spark, settings), **KEY_LAYOUT)
    write_table(due(curated, as_of)[1].withColumn("batch", F.lit(FULL)), settings.clean_pending, partition_by=("batch",))
    for path, empty, column in ((settings.stays, STAYS, "closed_date"), (settings.open_entries, OPEN_ENTRIES, "open_date"), (settings.visits_daily, VISITS, "visit_date")):
        write_table(spark.createDataFrame([], empty), path, partition_by=(column,))

    if with_graph:
        stays = spark.read.schema(durations.schema).parquet(settings.report("room_durations"))
        for name, table in G.graph_tables(students_table(spark, settings), clean, stays).items():
            if name in BY_DATE:
                write_table(table.withColumn("batch", F.lit(FULL)), settings.graph(name), partition_by=("record_date", "batch"))
            else:
                write_table(table, settings.graph(name))
        write_table(index_rows(clean, FULL, settings.key_buckets), settings.graph("event_keys"), **KEY_LAYOUT)
        # v_student has the students that the stream saw before.
        write_table(spark.createDataFrame([], STUDENT_SEEN), settings.graph("v_student_seen"), partition_by=("bucket", "batch"))


def graph_students(spark: SparkSession, settings: Settings) -> DataFrame:
    """The student vertices: those of the last whole-history run, and those that the stream has seen since."""
    stored = read_if_there(spark, settings.graph("v_student"), V_STUDENT)
    seen = read_if_there(spark, settings.graph("v_student_seen"), STUDENT_SEEN).select("student_id").distinct()
    new = seen.join(stored.select("student_id"), "student_id", "left_anti")
    known = students_table(spark, settings).select("student_id", "major", "year_of_study")
    return stored.unionByName(new.join(known, "student_id", "left"))


def run_daily_batch(spark: SparkSession, settings: Settings, show: bool = False, day: dt.date | None = None) -> None:
    """Latest day only (or the ``day`` given): a clean table of its own (the questions read the whole history's), each
    report replaces just that day's partitions, those without rows too, and the latest-day column sets are written as
    tables.

    The report tables keep one schema for both jobs: the hourly reports are written in their
    whole-history form (entries and exits), restricted to the day. Stays are paired within
    the day, as the latest-day report defines them. The day is found once, and every later
    step filters by its value.
    """
    curated = read_curated(spark, settings.curated)
    if day is None:  # from the directories, if the table is partitioned by date
        by_date = "record_date" in curated.columns
        day = latest_partition(spark, settings.curated, curated.schema) if by_date else latest_date(curated)
    curated = with_record_date(curated)
    # No rows, no day: nothing matches, and the tables are written empty.
    today = curated.filter(F.col("record_date") == F.lit(day).cast("date"))
    clean = _write_back(clean_events_daily(today, latest=True), settings.clean_daily)
    _publish(
        {
            "hourly_traffic": R.hourly_gate_traffic_full(clean, ordered=False),
            "daily_rooms": R.daily_room_usage_daily(clean, ordered=False),
            "hourly_room_usage": R.hourly_room_usage_full(clean, ordered=False),
            "room_durations": R.room_durations_daily(clean, ordered=False),
        },
        settings,
        show=show,
        days=[day] if day else [],
    )
    for name, df in daily_views(clean).items():
        write_table(df, settings.report(f"daily/{name}"))


def daily_views(clean: DataFrame) -> dict[str, DataFrame]:
    """The latest-day reports with the column sets of their own."""
    return {
        "hourly_traffic": R.hourly_gate_traffic_daily(clean),
        "daily_rooms": R.daily_room_usage_daily(clean),
        "hourly_room_usage": R.hourly_room_usage_daily(clean),
        "room_durations": R.room_durations_daily(clean),
    }


def analytics(
    spark: SparkSession, settings: Settings, as_of=None, trailing_days: int = 30
) -> dict[str, DataFrame]:
    """The five questions over the clean table written by the whole-history job."""
    clean = read_table(spark, settings.clean, CLEAN_EVENT)
    students = students_table(spark, settings)
    return {
        "top5_rooms_by_major_year": A.top_rooms_by_major_year(G.e_entered(clean), students),
        "daily_visits_by_period": A.daily_visits_by_period(clean, students, as_of, trailing_days),
        "visit_summary": A.visit_summary(clean),
        "peak_hours": A.peak_hours(clean),
        "popular_rooms": A.popular_rooms(clean),
    }


def run_analytics(
    spark: SparkSession, settings: Settings, as_of=None, trailing_days: int = 30, show: bool = False
) -> None:
    """Write every answer whole, as a table; ``show`` also prints the first rows."""
    for name, df in analytics(spark, settings, as_of, trailing_days).items():
        if show:
            preview(df, name)
        write_table(df, settings.path(f"analytics/{name}"))
