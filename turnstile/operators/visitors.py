"""Distinct students that add up over days: exact bitmaps of dense student numbers.

Distinct counts of days cannot be added, bitmaps can be joined by OR. Students get numbers without gaps; a row of the daily
table holds 32,768 of them as one bitmap (4 KB), so its size follows the students seen, not the events. The questions
on periods and on overall averages are answered from that table alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import local_hour, local_time, time_period, ts_cutoff
from turnstile.operators.analytics import (
    known_students,
    leading_groups,
    main_entries,
    summary_ratios,
    visits_by_period_major_year,
)
from turnstile.operators.quality import with_record_date
from turnstile.schema import LOCAL_OFFSET_HOURS

#: Students are numbered bucket by bucket, so that no task sees all of them.
NUMBER_BUCKETS = 4096


def number_students(students: DataFrame, known: DataFrame | None = None, buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """(student_id, number): numbers without gaps, from 1 on. Students of ``known`` keep theirs, new ones follow after the last.

    A student's place is that within a hash bucket plus the sizes of the buckets before it, so the numbers depend on
    the rows only and a task that is run again gives the same ones.
    """
    ids = students.select("student_id").filter(F.col("student_id").isNotNull()).distinct()
    if known is not None:
        ids = ids.join(known.select("student_id"), "student_id", "left_anti")
    dealt = ids.withColumn("_b", F.pmod(F.xxhash64("student_id"), F.lit(buckets)))
    sizes = dealt.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_b", before.alias("_offset"))  # one row a bucket
    place = F.row_number().over(Window.partitionBy("_b").orderBy("student_id"))
    numbered = dealt.withColumn("_place", place).join(offsets, "_b")
    if known is None:
        return numbered.select("student_id", (F.col("_offset") + F.col("_place")).alias("number"))
    last = known.select(F.coalesce(F.max("number"), F.lit(0))).scalar()
    new = numbered.select("student_id", (last + F.col("_offset") + F.col("_place")).alias("number"))
    return known.select("student_id", "number").unionByName(new)


def visits_daily(clean: DataFrame, students: DataFrame, numbers: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """(visit_date, local_date, time_period, major, year, bucket, visits, students): main-gate entries and the bitmap of their
    students, per stored date, local date, period and group of students (as the dimension has them when the day is
    written)."""
    per_student = (
        main_entries(clean)
        .groupBy(
            F.to_date("timestamp").alias("visit_date"),
            F.to_date(local_time("timestamp", offset_hours)).alias("local_date"),
            time_period(local_hour("timestamp", offset_hours)).alias("time_period"),
            "student_id",
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbered = per_student.join(numbers, "student_id", "left").join(known_students(students), "student_id", "left")
    return (
        numbered.withColumn("bucket", F.bitmap_bucket_number("number"))
        .groupBy("visit_date", "local_date", "time_period", "major", "year", "bucket")
        .agg(F.sum("n").alias("visits"), F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("students"))
    )


def distinct_students(daily: DataFrame, *by: str) -> DataFrame:
    """(by, visits, unique_students): the bitmaps of a bucket are joined, then counted and added."""
    joined = daily.groupBy(*by, "bucket").agg(F.sum("visits").alias("_v"), F.bitmap_or_agg("students").alias("_s"))
    return joined.groupBy(*by).agg(F.sum("_v").alias("visits"), F.sum(F.bitmap_count("_s")).alias("unique_students"))


def visits_by_period_from_daily(
    daily: DataFrame, clean: DataFrame, students: DataFrame, as_of, trailing_days: int = 30, offset_hours: int = LOCAL_OFFSET_HOURS
) -> DataFrame:
    """As ``visits_by_period_major_year``: whole days from the daily table; the day that the cut-off divides from its events
    (one day of ``clean``, pruned)."""
    cutoff = ts_cutoff(clean, "timestamp", as_of, trailing_days)
    whole = F.when(cutoff == F.date_trunc("day", cutoff), F.to_date(cutoff)).otherwise(F.date_add(F.to_date(cutoff), 1))
    groups = distinct_students(daily.filter(F.col("visit_date") >= whole), "visit_date", "time_period", "major", "year")
    divided = with_record_date(clean).filter((F.col("record_date") == F.to_date(cutoff)) & (F.col("record_date") < whole))
    return groups.unionByName(visits_by_period_major_year(divided, students, as_of, trailing_days, offset_hours))


def daily_visits_from_daily(daily: DataFrame, clean: DataFrame, students: DataFrame, as_of, trailing_days: int = 30) -> DataFrame:
    """As ``daily_visits_by_period``, from the daily table."""
    return leading_groups(visits_by_period_from_daily(daily, clean, students, as_of, trailing_days))


def visit_summary_from_daily(daily: DataFrame) -> DataFrame:
    """As ``visit_summary``, from the daily table."""
    joined = daily.groupBy("bucket").agg(F.sum("visits").alias("_v"), F.bitmap_or_agg("students").alias("_s"))
    counts = joined.agg(
        F.coalesce(F.sum("_v"), F.lit(0)).alias("total_entries"),
        F.coalesce(F.sum(F.bitmap_count("_s")), F.lit(0)).alias("unique_students"),
    )
    days = daily.select(F.countDistinct("local_date")).scalar()
    return summary_ratios(counts.withColumn("unique_days", days))
