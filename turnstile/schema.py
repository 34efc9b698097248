"""Schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original pipeline's values for the same
# results (gate and event codes, the main-hall location, the library vertex
# name, the two topic names, the local-time shift, the period bounds and the
# 12-hour clock labels).
# ---------------------------------------------------------------------------
MAIN_GATE = "MAIN_GATE"
ROOM_GATE = "ROOM_GATE"
ENTRY = "ENTRY"
EXIT = "EXIT"
MAIN_HALL = "MAIN_HALL"
LIBRARY_NAME = "Main Library"
TOPIC_MAIN_GATE = "main_gate_events"
TOPIC_ROOM_GATE = "room_gate_events"
LOCAL_OFFSET_HOURS = 8
# (label, first local hour, last local hour); any other hour is "Night".
TIME_PERIODS = (
    ("Morning", 6, 11),
    ("Afternoon", 12, 16),
    ("Evening", 17, 20),
)
NIGHT = "Night"
PERIOD_ORDER = ("Morning", "Afternoon", "Evening", "Night")
CLOCK_MIDNIGHT = "12:00 AM"
CLOCK_NOON = "12:00 PM"
CLOCK_AM_SUFFIX = ":00 AM"
CLOCK_PM_SUFFIX = ":00 PM"
# ---------------------------------------------------------------------------

EVENT_COLUMNS = ("event_id", "student_id", "event_type", "gate_type", "location", "timestamp")


def gate_event_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    """One gate event. ``timestamp`` defaults to TIMESTAMP (session zone = UTC);
    pass ``TimestampNTZType()`` for zone-less wall-clock sources."""
    ts_type = timestamp_type or T.TimestampType()
    return T.StructType(
        [T.StructField(name, T.StringType(), True) for name in EVENT_COLUMNS[:-1]]
        + [T.StructField("timestamp", ts_type, True)]
    )


GATE_EVENT = gate_event_schema()
GATE_EVENT_NTZ = gate_event_schema(T.TimestampNTZType())

# The student file is read as text (header names, no inference); year is cast later.
STUDENT_CSV = T.StructType(
    [
        T.StructField("student_id", T.StringType(), True),
        T.StructField("major", T.StringType(), True),
        T.StructField("year_of_study", T.StringType(), True),
        T.StructField("study_level", T.StringType(), True),
    ]
)

# The clean event table (timestamps as the session's kind; a test may write the zone-less one).
CLEAN_EVENT = T.StructType([*GATE_EVENT.fields, T.StructField("record_date", T.DateType(), True)])
STUDENT_DIM = T.StructType(
    [
        T.StructField("student_id", T.StringType(), True),
        T.StructField("major", T.StringType(), True),
        T.StructField("year_of_study", T.IntegerType(), True),
        T.StructField("study_level", T.StringType(), True),
    ]
)

# The index of merged event ids (``turnstile.operators.keys``).
KEY_INDEX = T.StructType(
    [
        T.StructField("event_id", T.StringType(), True),
        T.StructField("record_date", T.DateType(), True),
        T.StructField("bucket", T.IntegerType(), True),
        T.StructField("batch", T.StringType(), True),
    ]
)

STUDENT_DIM_COLUMNS = ("student_id", "major", "year_of_study", "study_level")
