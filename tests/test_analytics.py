import datetime as dt

from turnstile.operators import analytics as A
from turnstile.operators import graph as G
from turnstile.operators.quality import with_record_date


DIM = [("1", "Law", 1), ("2", "Law", 1), ("3", "Law", 2), ("4", "Art", 1), ("5", None, 1)]


def _dim(spark):
    return spark.createDataFrame(DIM, "student_id string, major string, year_of_study int")


def _main(eid, student, when, kind="ENTRY"):
    return (eid, student, kind, "MAIN_GATE", "MAIN_HALL", when)


def test_q1_ties_and_short_lists(spark, events):
    clean = with_record_date(events([
        ("a", "1", "ENTRY", "ROOM_GATE", "1B", "2026-03-05 08:00:00"),
        ("b", "2", "ENTRY", "ROOM_GATE", "1B", "2026-03-05 08:00:00"),
        ("c", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 08:00:00"),
        ("d", "2", "EXIT", "ROOM_GATE", "1C", "2026-03-05 08:00:00"),
        ("e", "1", "ENTRY", "ROOM_GATE", "1B", "2026-03-05 09:00:00"),  # same pair again: counted once
        ("f", "9", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 08:00:00"),  # unknown student: left out
        ("g", "5", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 08:00:00"),  # no major: left out
    ]))
    got = [tuple(r) for r in A.top_rooms_by_major_year(G.e_entered(clean), _dim(spark)).collect()]
    assert got == [("Law", 1, "1B", 2, "1A", 1, "1C", 1, None, None, None, None)]


def test_q2_periods_null_group_and_ties(spark, events):
    clean = with_record_date(events([
        # 22:00 UTC + 8 h = 06:00 local: Morning; the date stays the UTC date
        _main("a", "9", "2026-03-04 22:00:00"),
        _main("b", "8", "2026-03-04 22:30:00"),
        _main("c", "1", "2026-03-04 23:00:00"),
        # 03:59 UTC = 11:59 Morning, 04:00 = 12:00 Afternoon
        _main("d", "1", "2026-03-05 03:59:00"),
        _main("e", "4", "2026-03-05 04:00:00"),
        _main("f", "1", "2026-03-05 04:00:01"),
        _main("g", "4", "2026-03-05 04:30:00"),
        _main("h", "1", "2026-03-05 05:00:00", kind="EXIT"),
        # before the cut-off: ignored; exactly at it: kept
        _main("i", "1", "2026-02-01 00:00:00"),
        _main("j", "2", "2026-02-03 00:00:00"),
    ]))
    out = A.daily_visits_by_period(clean, _dim(spark), as_of="2026-03-05 00:00:00", trailing_days=30)
    got = [tuple(r) for r in out.collect()]
    assert got == [
        (dt.date(2026, 3, 5), "Morning", 1, 1, "Law", 1),
        (dt.date(2026, 3, 5), "Afternoon", 3, 2, "Art", 1),   # Art 2 > Law 1
        (dt.date(2026, 3, 4), "Morning", 3, 3, None, None),   # unknown students win (2 > 1)
        (dt.date(2026, 2, 3), "Morning", 1, 1, "Law", 1),
    ]


def test_q2_tie_goes_to_smaller_major_then_year(spark, events):
    clean = with_record_date(events([
        _main("a", "4", "2026-03-05 01:00:00"),
        _main("b", "1", "2026-03-05 01:00:00"),
        _main("c", "3", "2026-03-05 01:30:00"),
        _main("d", "9", "2026-03-05 01:40:00"),
    ]))
    out = A.daily_visits_by_period(clean, _dim(spark), as_of="2026-03-06 00:00:00")
    # Law (1 + 1) beats Art and unknown (1 each); within Law years 1 and 2 tie: year 1
    assert [tuple(r) for r in out.collect()] == [(dt.date(2026, 3, 5), "Morning", 4, 4, "Law", 1)]


def test_q3_zero_counts_give_nulls(spark, events):
    clean = with_record_date(events([("a", "1", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 01:00:00")]))
    r = A.visit_summary(clean).first()
    assert (r.total_entries, r.unique_students, r.unique_days) == (0, 0, 0)
    assert r.visits_per_student is None and r.visits_per_day is None


def test_q3_local_days(spark, events):
    clean = with_record_date(events([
        _main("a", "1", "2026-03-04 15:59:00"),  # local 23:59 on the 4th
        _main("b", "1", "2026-03-04 16:00:00"),  # local 00:00 on the 5th
        _main("c", "2", "2026-03-04 17:00:00"),
    ]))
    r = A.visit_summary(clean).first()
    assert (r.total_entries, r.unique_students, r.unique_days) == (3, 2, 2)
    assert r.visits_per_student == 1.5 and r.visits_per_day == 1.5 and r.visits_per_student_per_day == 0.75


def test_q4_q5(spark, events):
    data = [_main(f"m{i}", "1", f"2026-03-05 {h:02d}:00:00") for i, h in enumerate([1, 1, 4, 4, 16, 16, 0, 5, 3])]
    data += [
        ("r1", "1", "ENTRY", "ROOM_GATE", "1B", "2026-03-05 08:00:00"),
        ("r2", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 08:00:00"),
        ("r3", "1", "EXIT", "ROOM_GATE", "1C", "2026-03-05 08:00:00"),
        ("r4", "1", "ENTRY", "ROOM_GATE", "MAIN_HALL", "2026-03-05 08:00:00"),
    ]
    clean = with_record_date(events(data))
    got = [tuple(r) for r in A.peak_hours(clean).collect()]
    assert got == [(0, "12:00 AM", 2), (9, "9:00 AM", 2), (12, "12:00 PM", 2), (8, "8:00 AM", 1), (11, "11:00 AM", 1)]
    assert [tuple(r) for r in A.popular_rooms(clean).collect()] == [("1A", 1), ("1B", 1)]
