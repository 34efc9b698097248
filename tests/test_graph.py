import datetime as dt

from turnstile.operators import graph as G
from turnstile.operators import reports as R
from turnstile.operators.quality import with_record_date

from conftest import rows


def test_students_dim_types_and_duplicates(spark):
    raw = spark.createDataFrame(
        [("1", "Law", "2", "Undergraduate"), ("2", "Law", "x", "Postgraduate"), ("2", "Law", " 3 ", "Postgraduate"),
         (None, "Law", "1", "Undergraduate")],
        "student_id string, major string, year_of_study string, study_level string",
    )
    got = rows(G.students_dim(raw))
    assert got == [("1", "Law", 2, "Undergraduate"), ("2", "Law", 3, "Postgraduate")]


def test_vertices_and_entered(spark, events):
    clean = with_record_date(events([
        ("a", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 08:00:00"),
        ("b", "9", "EXIT", "ROOM_GATE", "1A", "2026-03-05 08:10:00"),   # exit-only visitor
        ("c", "9", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 09:10:00"),  # repeated visit
    ]))
    dim = spark.createDataFrame([("1", "Law", 1), ("5", "Law", 2)], "student_id string, major string, year_of_study int")
    assert rows(G.v_student(dim, clean)) == [("1", "Law", 1), ("5", "Law", 2), ("9", None, None)]
    assert rows(G.e_entered(clean)) == [("9", "1A")]
    assert rows(G.v_room(clean)) == [("1A",)]
    assert rows(G.e_at_library(clean)) == [("a", "Main Library")]
    assert rows(G.v_library(clean)) == [("Main Library",)]
    assert rows(G.v_library(clean.limit(0))) == []


def test_studied_in_last_stay_wins(spark, events):
    clean = with_record_date(events([
        ("a", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 08:00:00"),
        ("b", "1", "EXIT", "ROOM_GATE", "1A", "2026-03-05 09:00:00"),
        ("c", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 10:00:00"),
        ("d", "1", "EXIT", "ROOM_GATE", "1A", "2026-03-05 10:30:00"),
        ("e", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-06 10:00:00"),
        ("f", "1", "EXIT", "ROOM_GATE", "1A", "2026-03-06 10:15:00"),
    ]))
    got = rows(G.e_studied_in(R.room_durations(clean, ordered=False)))
    assert got == [
        ("1", "1A", dt.date(2026, 3, 5), 30.0, dt.datetime(2026, 3, 5, 10), dt.datetime(2026, 3, 5, 10, 30)),
        ("1", "1A", dt.date(2026, 3, 6), 15.0, dt.datetime(2026, 3, 6, 10), dt.datetime(2026, 3, 6, 10, 15)),
    ]
