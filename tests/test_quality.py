import datetime as dt

from turnstile.operators.quality import clean_events_daily, clean_events_full, latest_day

from conftest import rows

AS_OF = "2026-03-06 00:00:00"


def test_clean_full_cases(spark, events):
    df = events([
        ("n", None, "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 08:00:00"),       # null student
        ("t", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", None),                         # null time
        ("f", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-06 00:00:01"),        # future
        ("e", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-06 00:00:00"),        # = as_of, kept
        ("d", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 09:00:00"),        # identical copies
        ("d", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 09:00:00"),
        ("g", None, "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 10:00:00"),       # bad + good copy
        ("g", "2", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 10:05:00"),
        ("k", "3", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 11:05:00"),         # earliest copy kept
        ("k", "3", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 11:00:00"),
    ])
    got = rows(clean_events_full(df, as_of=AS_OF), "event_id", "student_id", "timestamp")
    assert got == [
        ("d", "1", dt.datetime(2026, 3, 5, 9)),
        ("e", "1", dt.datetime(2026, 3, 6)),
        ("g", "2", dt.datetime(2026, 3, 5, 10, 5)),
        ("k", "3", dt.datetime(2026, 3, 5, 11)),
    ]


def test_clean_is_stable_under_input_order(spark, events):
    base = [
        ("k", "3", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 11:00:00"),
        ("k", "4", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 11:00:00"),
        ("k", "3", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 11:00:00"),
    ]
    a = rows(clean_events_full(events(base), as_of=AS_OF))
    b = rows(clean_events_full(events(list(reversed(base))).repartition(3), as_of=AS_OF))
    assert a == b and a[0][2] == "ENTRY"


def test_latest_day(spark, events):
    df = events([
        ("a", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-04 08:00:00"),
        ("b", None, "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 23:59:59"),
        ("c", "1", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 08:00:00"),
    ])
    assert rows(latest_day(df), "event_id") == [("b",), ("c",)]
    # the latest date is taken before cleaning; the null-student row then goes
    assert rows(clean_events_daily(df), "event_id") == [("c",)]


def test_latest_day_single_and_empty(spark, events):
    one = events([("a", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-04 08:00:00")])
    assert latest_day(one).count() == 1
    assert latest_day(one.limit(0)).count() == 0


def test_as_of_with_zone_is_taken_as_an_instant(spark, events):
    df = events([
        ("a", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 15:59:59"),
        ("b", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 16:00:01"),
    ])
    # 2026-03-06 00:00 at UTC+8 is 2026-03-05 16:00 UTC
    assert rows(clean_events_full(df, as_of="2026-03-06T00:00:00+08:00"), "event_id") == [("a",)]
    assert rows(clean_events_full(df, as_of="2026-03-06 00:00:00"), "event_id") == [("a",), ("b",)]
