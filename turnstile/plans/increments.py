"""Whole-history results kept up to date by increments: what arrived since the last run touches some days, and only these are
written again.

The rows that are new come from the curated table read as a stream (its checkpoint knows what has been merged), one
micro-batch after the other. Each step is a replacement of named partitions. What a batch changes is written to the index of ids
first, under the batch's name: a batch that fails half way finds there what it had changed, and leaves the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.config import Settings
from turnstile.operators import carry as C
from turnstile.operators import reports as R
from turnstile.operators import visitors as V
from turnstile.operators.increments import changed_copies, due, located, redone
from turnstile.operators.keys import FULL, index_rows, key_bucket, newest, read_keys, touched
from turnstile.operators.quality import dedupe_events, with_record_date
from turnstile.plans.jobs import (
    CLEAN_CLUSTER,
    CLEAN_PARTITIONS,
    KEY_LAYOUT,
    OPEN_ENTRIES,
    PENDING,
    STAYS,
    VISITS,
    keys_path,
    students_table,
)
from turnstile.schema import CLEAN_EVENT
from turnstile.sinks import replace_days, write_report, write_table
from turnstile.sources import partition_days, partitions, read_if_there
from turnstile.streaming.ingest import batch_name

#: Batches whose rows the index of ids keeps apart.
FOLD = 100
NUMBERS = "student_id STRING, number BIGINT, batch STRING"


def _staged(df: DataFrame, settings: Settings, name: str, **layout) -> DataFrame:
    """Written and read back: it is used several times, and tables that it was read from change."""
    path = settings.path(f"staging/{name}")
    write_table(df, path, **layout)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clean(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_if_there(spark, settings.clean, CLEAN_EVENT)


def merge_rows(spark: SparkSession, settings: Settings, rows: DataFrame, batch: str, as_of) -> list[dt.date]:
    """Merge curated rows into the clean table; the days that changed."""
    columns = CLEAN_EVENT.fieldNames()
    now, later = due(with_record_date(rows).select(*columns), as_of)
    waiting = read_if_there(spark, settings.clean_pending, PENDING).filter(F.col("batch") != batch)
    released, _ = due(waiting.select(*columns), as_of)
    write_table(later.withColumn("batch", F.lit(batch)), settings.clean_pending, partition_by=("batch",), dynamic=True)

    increment = dedupe_events(now.unionByName(released)).withColumn("bucket", key_bucket("event_id", settings.key_buckets)).persist()
    buckets = touched(increment, "bucket")
    keys = keys_path(spark, settings)
    found = located(increment.drop("bucket"), newest(read_keys(spark, keys, buckets, but=batch))).persist()
    clean = _clean(spark, settings)
    # The kept copies, each on its own day; what an earlier run of this batch put there has no say.
    places = found.select("event_id", F.col("old_date").alias("record_date"))
    own = read_keys(spark, keys, buckets).filter(F.col("batch") == batch)
    stored = clean.filter(F.col("record_date").isin(touched(found, "old_date"))).join(places, ["event_id", "record_date"], "left_semi")
    stored = stored.join(own.select("event_id"), "event_id", "left_anti").select(*columns)
    changed = _staged(changed_copies(found, stored), settings, "changed")
    increment.unpersist(), found.unpersist()
    days = sorted({*touched(changed, "record_date"), *touched(changed, "old_date")})
    if days:
        write_table(index_rows(changed, batch, settings.key_buckets), keys, dynamic=True, **KEY_LAYOUT)
        content = redone(clean.filter(F.col("record_date").isin(days)), changed)
        content = _staged(content, settings, "clean", partition_by=CLEAN_PARTITIONS, cluster_by=CLEAN_CLUSTER)
        replace_days(content, settings.clean, days, partition_by=CLEAN_PARTITIONS)
    return days


def fold_keys(spark: SparkSession, settings: Settings, batches: int = FOLD) -> bool:
    """Write the index anew from the clean table once more than ``batches`` batches have their partitions in it, so that its
    folders stay few. It goes to a folder of its own, which counts when it is whole. Only while no batch is unfinished."""
    path = keys_path(spark, settings)
    if len({name for _, name in partitions(spark, path, "bucket INT, batch STRING")}) <= batches:
        return False
    version = int(path.rsplit("/", 1)[1]) + 1
    write_table(index_rows(_clean(spark, settings), FULL, settings.key_buckets), f"{settings.clean_keys}/{version:06d}", **KEY_LAYOUT)
    write_table(spark.createDataFrame([(version,)], "version INT"), f"{settings.clean_keys}_folded", mode="append")
    return True


def refresh_reports(spark: SparkSession, settings: Settings, days: list[dt.date]) -> None:
    """The reports that depend on a day alone."""
    clean = _clean(spark, settings).filter(F.col("record_date").isin(days))
    for name, report in (
        ("hourly_traffic", R.hourly_gate_traffic_full),
        ("daily_rooms", R.daily_room_usage_full),
        ("hourly_room_usage", R.hourly_room_usage_full),
    ):
        write_report(report(clean, ordered=False), settings.report(name), days)


def refresh_stays(spark: SparkSession, settings: Settings, days: list[dt.date]) -> None:
    """Stays that end on the first changed day or later, and the entries open at the end of these days.

    They start from the entries open before the first changed day. Where none are kept (no increment ran since the last
    whole-history run), they start from the first day of all.
    """
    first = days[0]
    kept = [d for d in partition_days(spark, settings.open_entries, "open_date") if d < first]
    present = partition_days(spark, settings.clean)
    if kept and max(kept) == max((d for d in present if d < first), default=None):
        before = read_if_there(spark, settings.open_entries, OPEN_ENTRIES).filter(F.col("open_date") == F.lit(max(kept)))
    else:
        before, first = None, min([first, *present])
    redo = sorted({d for d in (*present, *days) if d >= first})
    clean = _clean(spark, settings).filter(F.col("record_date") >= F.lit(first))
    stays = read_if_there(spark, settings.stays, STAYS)
    earlier, stale = stays.filter(F.col("closed_date") < F.lit(first)), stays.filter(F.col("closed_date") >= F.lit(first))
    new = _staged(C.closed_stays(clean, before), settings, "stays")
    opened = _staged(C.open_entries(clean, before, redo), settings, "open_entries")
    # The report is dated by entries. It is written before the table of stays, which shows what was stale: a run that fails
    # in between finds it again.
    dated = sorted({*touched(stale, "record_date"), *touched(new, "record_date"), *days})
    earlier = earlier.filter(F.col("closed_date") >= F.lit(dated[0]))
    report = new.unionByName(earlier).filter(F.col("record_date").isin(dated)).drop("closed_date")
    write_report(report, settings.report("room_durations"), dated)
    replace_days(opened, settings.open_entries, redo, partition_by=("open_date",))
    # A day without an open entry is kept as such: the next increment looks for its directory.
    none = spark.createDataFrame([], opened.drop("open_date").schema)
    for day in set(redo) - set(partition_days(spark, settings.open_entries, "open_date")):
        write_table(none, f"{settings.open_entries}/open_date={day.isoformat()}")
    replace_days(new, settings.stays, redo, partition_by=("closed_date",))


def refresh_visits(spark: SparkSession, settings: Settings, days: list[dt.date], batch: str) -> None:
    """The daily table of visits and student bitmaps; students seen for the first time get numbers."""
    missing = set(partition_days(spark, settings.clean)) - set(partition_days(spark, settings.visits_daily, "visit_date"))
    days = sorted({*days, *missing})
    clean = _clean(spark, settings).filter(F.col("record_date").isin(days))
    known = read_if_there(spark, settings.student_numbers, NUMBERS).filter(F.col("batch") != batch)
    numbers = V.number_students(clean, known)
    new = numbers.join(known.select("student_id"), "student_id", "left_anti").withColumn("batch", F.lit(batch))
    write_table(new, settings.student_numbers, partition_by=("batch",), dynamic=True)
    numbers = read_if_there(spark, settings.student_numbers, NUMBERS).select("student_id", "number")
    visits = V.visits_daily(clean, students_table(spark, settings), numbers)
    replace_days(visits, settings.visits_daily, days, partition_by=("visit_date",))


def merge_increment(settings: Settings, as_of=None):
    """The ``foreachBatch`` function of the increment."""

    def merge(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        batch = batch_name(spark, settings, batch_id)
        days = merge_rows(spark, settings, rows, batch, as_of or dt.datetime.now(dt.timezone.utc))
        if days:
            refresh_reports(spark, settings, days)
            refresh_stays(spark, settings, days)
            refresh_visits(spark, settings, days, batch)

    return merge


def run_increment(spark: SparkSession, settings: Settings, as_of=None, max_files: int | None = None) -> None:
    """Merge what the curated table got since the last increment, and stop. ``max_files`` bounds a micro-batch."""
    schema = spark.read.parquet(settings.curated).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(settings.curated)
        .writeStream.foreachBatch(merge_increment(settings, as_of))
        .option("checkpointLocation", settings.checkpoint("increment"))
        .trigger(availableNow=True)
        .queryName("increment")
        .start()
    )
    query.awaitTermination()
    fold_keys(spark, settings)


def questions_from_daily(spark: SparkSession, settings: Settings, as_of, trailing_days: int = 30) -> dict[str, DataFrame]:
    """The questions on periods and averages, from the daily table."""
    daily = read_if_there(spark, settings.visits_daily, VISITS)
    clean, students = _clean(spark, settings), students_table(spark, settings)
    return {
        "daily_visits_by_period": V.daily_visits_from_daily(daily, clean, students, as_of, trailing_days),
        "visit_summary": V.visit_summary_from_daily(daily),
    }
