"""The five analytical questions asked of the graph, answered on the clean event table.

Every graph pattern of those questions is a projection of one event table (an event, its
student, its gate, its room), so the questions read that table directly instead of joining
its projections back together. Event-level data is aggregated before it meets the student
dimension: a student with a huge share of events becomes a handful of rows first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import clock_label, local_hour, local_time, period_rank, time_period, ts_cutoff
from turnstile.schema import ENTRY, LOCAL_OFFSET_HOURS, MAIN_GATE, MAIN_HALL, ROOM_GATE

TOP_ROOMS = 5


def known_students(students: DataFrame) -> DataFrame:
    """Students with both a major and a year (the only ones the questions group by)."""
    return students.filter(F.col("major").isNotNull() & F.col("year_of_study").isNotNull()).select(
        "student_id", "major", F.col("year_of_study").alias("year")
    )


def main_entries(clean: DataFrame) -> DataFrame:
    return clean.filter((F.col("gate_type") == MAIN_GATE) & (F.col("event_type") == ENTRY))


# -- Q1 -------------------------------------------------------------------------------------

def room_popularity_by_group(entered: DataFrame, students: DataFrame, count_mode: str = "students") -> DataFrame:
    """(major, year, room, visits) from ``entered``.

    ``count_mode="students"``: ``entered`` is the distinct (student, room) edge table and visits
    are its rows, students who have been there. ``"visits"``: ``entered`` is the clean event table
    and visits are entries at room gates; they are summed per student before the join.
    """
    if count_mode == "visits":
        entered = entered.filter((F.col("gate_type") == ROOM_GATE) & (F.col("event_type") == ENTRY))
        entered = entered.groupBy("student_id", "location").agg(F.count(F.lit(1)).alias("n"))
    elif count_mode == "students":
        entered = entered.withColumn("n", F.lit(1).cast("long"))
    else:
        raise ValueError(f"count_mode must be 'students' or 'visits', not {count_mode!r}")
    return (
        entered.filter(F.col("location") != MAIN_HALL)
        .join(known_students(students), "student_id")
        .groupBy("major", "year", F.col("location").alias("room"))
        .agg(F.sum("n").alias("visits"))
    )


def top_rooms_by_major_year(
    entered: DataFrame, students: DataFrame, top: int = TOP_ROOMS, count_mode: str = "students"
) -> DataFrame:
    """Top rooms per (major, year) in wide form: top_room_i / visits_i for i = 1..top,
    null past the number of rooms. Ties go to the smaller room name. For ``entered`` and
    ``count_mode`` see ``room_popularity_by_group``.
    """
    ranked = room_popularity_by_group(entered, students, count_mode).withColumn(
        "_rk",
        F.row_number().over(
            Window.partitionBy("major", "year").orderBy(F.col("visits").desc(), F.col("room").asc_nulls_last())
        ),
    ).filter(F.col("_rk") <= top)
    cells = []
    for i in range(1, top + 1):
        cells.append(F.max(F.when(F.col("_rk") == i, F.col("room"))).alias(f"top_room_{i}"))
        cells.append(F.max(F.when(F.col("_rk") == i, F.col("visits"))).alias(f"visits_{i}"))
    return ranked.groupBy("major", "year").agg(*cells).orderBy("major", "year")


# -- Q2 -------------------------------------------------------------------------------------

def _period_entries(
    clean: DataFrame,
    as_of=None,
    trailing_days: int = 30,
    offset_hours: int = LOCAL_OFFSET_HOURS,
    local_dates: bool = False,
) -> DataFrame:
    """(visit_date, time_period, student_id, n) for main-gate entries since ``as_of - days``.

    The period uses local time (``offset_hours``); the date is the stored (UTC) date unless
    ``local_dates`` is set.
    """
    cutoff = ts_cutoff(clean, "timestamp", as_of, trailing_days)
    dated = local_time("timestamp", offset_hours) if local_dates else F.col("timestamp")
    return (
        main_entries(clean)
        .filter(F.col("timestamp").isNotNull() & (F.col("timestamp") >= cutoff))
        .groupBy(
            F.to_date(dated).alias("visit_date"),
            time_period(local_hour("timestamp", offset_hours)).alias("time_period"),
            "student_id",
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def visits_by_period_major_year(
    clean: DataFrame, students: DataFrame, as_of=None, trailing_days: int = 30,
    offset_hours: int = LOCAL_OFFSET_HOURS, local_dates: bool = False,
) -> DataFrame:
    """Entries and distinct students per (date, period, major, year); events of unknown
    students form the (null, null) group."""
    per_student = _period_entries(clean, as_of, trailing_days, offset_hours, local_dates)
    return (
        per_student.join(known_students(students), "student_id", "left")
        .groupBy("visit_date", "time_period", "major", "year")
        .agg(F.sum("n").alias("visits"), F.count("student_id").alias("unique_students"))
    )


def daily_visits_by_period(
    clean: DataFrame, students: DataFrame, as_of=None, trailing_days: int = 30,
    offset_hours: int = LOCAL_OFFSET_HOURS, local_dates: bool = False,
) -> DataFrame:
    """Per (date, period): entries, distinct students, the major with most entries (the
    unknown-student group may win) and that major's year with most entries."""
    return leading_groups(visits_by_period_major_year(clean, students, as_of, trailing_days, offset_hours, local_dates))


def leading_groups(groups: DataFrame) -> DataFrame:
    """Groups (date, period, major, year, visits, unique_students) to one row per (date, period).

    Ties: smaller major / year wins, null last. Each student sits in exactly one
    (major, year) group, so the cell totals are sums over the groups: the whole question is
    one small aggregate and windows over it, with a single exchange on the cell.
    """
    cell = ["visit_date", "time_period"]
    groups = groups.repartition(*cell)
    in_cell = Window.partitionBy(*cell)
    totals = groups.select(
        "*",
        F.sum("visits").over(Window.partitionBy(*cell, "major")).alias("_major_total"),
        F.sum("visits").over(in_cell).alias("_cell_visits"),
        F.sum("unique_students").over(in_cell).alias("_cell_students"),
    )
    leader = in_cell.orderBy(
        F.col("_major_total").desc(),
        F.col("major").asc_nulls_last(),
        F.col("visits").desc(),
        F.col("year").asc_nulls_last(),
    )
    return (
        totals.select("*", F.row_number().over(leader).alias("_rk"))
        .filter(F.col("_rk") == 1)
        .select(
            *cell,
            F.col("_cell_visits").alias("visits"),
            F.col("_cell_students").alias("unique_students"),
            F.col("major").alias("most_visited_major"),
            F.col("year").alias("most_visited_major_study_year"),
        )
        .orderBy(F.col("visit_date").desc(), period_rank(F.col("time_period")))
    )


# -- Q3 -------------------------------------------------------------------------------------

def visit_summary(clean: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """Main-gate entries, distinct students and distinct local days, and their ratios
    (null instead of an error when a count is zero)."""
    # Counted per student and day first: the distinct counts then see that small table only.
    day = F.to_date(local_time("timestamp", offset_hours)).alias("day")
    daily = main_entries(clean).groupBy("student_id", day).agg(F.count(F.lit(1)).alias("n"))
    counts = daily.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_entries"),
        F.countDistinct("student_id").alias("unique_students"),
        F.countDistinct("day").alias("unique_days"),
    )
    return summary_ratios(counts)


def summary_ratios(counts: DataFrame) -> DataFrame:
    """(total_entries, unique_students, unique_days) with their ratios."""
    total = F.col("total_entries").cast("double")
    per_student = F.try_divide(total, F.col("unique_students").cast("double"))
    return counts.select(
        "total_entries",
        "unique_students",
        "unique_days",
        per_student.alias("visits_per_student"),
        F.try_divide(total, F.col("unique_days").cast("double")).alias("visits_per_day"),
        F.try_divide(per_student, F.col("unique_days").cast("double")).alias("visits_per_student_per_day"),
    )


# -- Q4 -------------------------------------------------------------------------------------

def peak_hours(clean: DataFrame, top: int = 5, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """The ``top`` local hours by main-gate entries (ties: earlier hour), with a clock label."""
    return (
        main_entries(clean)
        .groupBy(local_hour("timestamp", offset_hours).alias("local_hour"))
        .agg(F.count(F.lit(1)).alias("visits"))
        .orderBy(F.col("visits").desc(), F.col("local_hour").asc_nulls_last())
        .limit(top)
        .select("local_hour", clock_label(F.col("local_hour")).alias("time"), "visits")
    )


# -- Q5 -------------------------------------------------------------------------------------

def popular_rooms(clean: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` rooms by room-gate entries (ties: smaller room name)."""
    return (
        clean.filter(
            (F.col("gate_type") == ROOM_GATE)
            & (F.col("event_type") == ENTRY)
            & (F.col("location") != MAIN_HALL)
        )
        .groupBy(F.col("location").alias("room"))
        .agg(F.count(F.lit(1)).alias("visits"))
        .orderBy(F.col("visits").desc(), F.col("room").asc_nulls_last())
        .limit(top)
    )
