"""The property graph as vertex and edge tables, derived by Spark from the clean events,
the student dimension and the stay durations.

Nothing is collected: each table is a projection, filter, distinct or keyed aggregation
of a distributed input, written like any other table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.schema import LIBRARY_NAME, MAIN_GATE, ROOM_GATE


def whole_number(column: str) -> Column:
    """Text to INT: whole numbers and decimals (cut towards zero), else null."""
    text = F.trim(column)
    number = F.when(text.rlike(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"), text)
    return F.coalesce(number.try_cast("int"), number.try_cast("double").try_cast("int"))


def students_dim(raw: DataFrame) -> DataFrame:
    """Typed student dimension, one row per ``student_id``.

    ``year_of_study`` is text in the file: a decimal is cut to its whole part ("3.0" is 3),
    as the original's integer conversion does, and what is not a number becomes null. Should an id appear twice, the row kept is the largest (major, year, level) — stable, and
    an aggregation with a partial step, so a repeated id never gathers in one task.
    """
    typed = raw.filter(F.col("student_id").isNotNull()).select(
        "student_id",
        "major",
        whole_number("year_of_study").alias("year_of_study"),
        "study_level",
    )
    best = F.max(F.struct("major", "year_of_study", "study_level")).alias("_best")
    return typed.groupBy("student_id").agg(best).select(
        "student_id",
        F.col("_best.major").alias("major"),
        F.col("_best.year_of_study").alias("year_of_study"),
        F.col("_best.study_level").alias("study_level"),
    )


def rejected_students(raw: DataFrame) -> DataFrame:
    """(line, student_id, reason): rows of the student file that the dimension leaves out, or takes without a year.

    ``raw`` has the column ``unread`` (``read_students_csv(unread=True)``): the line as it is where it has too few or too
    many fields.
    """
    year = F.col("year_of_study")
    reason = (
        F.when(F.col("student_id").isNull(), "no student_id")
        .when(F.col("unread").isNotNull(), "wrong number of fields")
        .when(year.isNotNull() & whole_number("year_of_study").isNull(), "year is no number")
    )
    found = raw.select(F.col("unread").alias("line"), "student_id", reason.alias("reason"))
    return found.filter(F.col("reason").isNotNull())


def v_student(students: DataFrame, clean: DataFrame) -> DataFrame:
    """Student vertices: every student of the dimension and every student seen in events
    (the latter with null major / year when unknown)."""
    seen = clean.select("student_id").filter(F.col("student_id").isNotNull()).distinct()
    dim = students.select("student_id", "major", "year_of_study")
    return dim.join(seen, "student_id", "full_outer").select("student_id", "major", "year_of_study")


def v_event(clean: DataFrame) -> DataFrame:
    """Event vertices (one per id after cleaning)."""
    return clean.select("event_id", "event_type", "gate_type", "location", "timestamp")


def v_library(events: DataFrame) -> DataFrame:
    """The single library vertex; present once any valid event exists. Any such event will do, so
    give it the valid events before the dedupe: one row is read, nothing is shuffled."""
    return events.limit(1).select(F.lit(LIBRARY_NAME).alias("name"))


def v_room(clean: DataFrame) -> DataFrame:
    """Room vertices: every location seen at a room gate."""
    return clean.filter(F.col("gate_type") == ROOM_GATE).select("location").distinct()


def e_performed(clean: DataFrame) -> DataFrame:
    return clean.select("student_id", "event_id")


def e_at_library(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("gate_type") == MAIN_GATE).select(
        "event_id", F.lit(LIBRARY_NAME).alias("name")
    )


def e_in_room(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("gate_type") == ROOM_GATE).select("event_id", "location")


def e_entered(clean: DataFrame) -> DataFrame:
    """Student -> room, once per pair, from any room-gate event (entry or exit)."""
    return clean.filter(F.col("gate_type") == ROOM_GATE).select("student_id", "location").distinct()


def e_studied_in(durations: DataFrame) -> DataFrame:
    """One stay edge per (student, room, date): the latest stay of the day wins (latest
    entry, then latest exit). A keyed max with a partial step, not a window."""
    latest = F.max(F.struct("entry_time", "exit_time", "occupied_minutes")).alias("_last")
    return (
        durations.groupBy("student_id", F.col("room_id").alias("location"), F.col("record_date").alias("date"))
        .agg(latest)
        .select(
            "student_id",
            "location",
            "date",
            F.col("_last.occupied_minutes").alias("duration_minutes"),
            F.col("_last.entry_time").alias("entry_time"),
            F.col("_last.exit_time").alias("exit_time"),
        )
    )


def _dated(table: DataFrame, clean: DataFrame) -> DataFrame:
    """An event projection of ``clean`` with the date it is stored under."""
    return clean.select(*table.columns, "record_date")


def graph_tables(students: DataFrame, clean: DataFrame, durations: DataFrame) -> dict[str, DataFrame]:
    """All vertex and edge tables, by name; the event tables also have the ``record_date``."""
    return {
        "v_student": v_student(students, clean),
        "v_event": _dated(v_event(clean), clean),
        "v_library": v_library(clean),
        "v_room": v_room(clean),
        "e_performed": _dated(e_performed(clean), clean),
        "e_at_library": e_at_library(clean),
        "e_in_room": e_in_room(clean),
        "e_entered": e_entered(clean),
        "e_studied_in": e_studied_in(durations),
    }
