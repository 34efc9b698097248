import datetime as dt
import random

import pytest

from turnstile.operators import reports as R
from turnstile.operators.pairing import pair_entries
from turnstile.operators.quality import with_record_date

from conftest import rows


def _room(eid, student, kind, loc, when):
    return (eid, student, kind, "ROOM_GATE", loc, when)


def test_hourly_gate_traffic_exit_only_hour(spark, events):
    df = with_record_date(events([
        ("a", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 00:10:00"),
        ("b", "1", "EXIT", "MAIN_GATE", "MAIN_HALL", "2026-03-05 23:50:00"),
        ("c", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 00:20:00"),
    ]))
    full = rows(R.hourly_gate_traffic_full(df))
    assert full == [(dt.date(2026, 3, 5), 0, 1, 0), (dt.date(2026, 3, 5), 23, 0, 1)]
    daily = rows(R.hourly_gate_traffic_daily(df))
    assert daily == [(dt.date(2026, 3, 5), 0, 1)]
    assert R.hourly_gate_traffic_full(df).schema["total_hourly_entries"].dataType.simpleString() == "bigint"


def test_room_usage_reports(spark, events):
    df = with_record_date(events([
        _room("a", "1", "ENTRY", "1A", "2026-03-05 10:00:00"),
        _room("b", "2", "ENTRY", "1A", "2026-03-05 10:30:00"),
        _room("c", "1", "EXIT", "1A", "2026-03-05 11:00:00"),
        _room("d", "3", "ENTRY", "1B", "2026-03-05 11:10:00"),
    ]))
    assert [tuple(r) for r in R.daily_room_usage(df).collect()] == [
        (dt.date(2026, 3, 5), "1A", 2), (dt.date(2026, 3, 5), "1B", 1),
    ]
    assert rows(R.hourly_room_usage_full(df)) == [
        (dt.date(2026, 3, 5), "1A", 10, 2, 0), (dt.date(2026, 3, 5), "1A", 11, 0, 1), (dt.date(2026, 3, 5), "1B", 11, 1, 0),
    ]
    assert rows(R.hourly_room_usage_daily(df)) == [(dt.date(2026, 3, 5), "1A", 10, 2), (dt.date(2026, 3, 5), "1B", 11, 1)]


def test_duration_cases(spark, events):
    df = with_record_date(events([
        # plain pair
        _room("a1", "1", "ENTRY", "1A", "2026-03-05 10:00:00"),
        _room("a2", "1", "EXIT", "1A", "2026-03-05 10:45:30"),
        # ENTRY, ENTRY, EXIT: one stay, from the second entry
        _room("b1", "2", "ENTRY", "1A", "2026-03-05 10:00:00"),
        _room("b2", "2", "ENTRY", "1A", "2026-03-05 10:10:00"),
        _room("b3", "2", "EXIT", "1A", "2026-03-05 10:20:00"),
        # EXIT first, then an open ENTRY: nothing
        _room("c1", "3", "EXIT", "1A", "2026-03-05 09:00:00"),
        _room("c2", "3", "ENTRY", "1A", "2026-03-05 12:00:00"),
        # EXIT, EXIT: nothing
        _room("d1", "4", "EXIT", "1A", "2026-03-05 09:00:00"),
        _room("d2", "4", "EXIT", "1A", "2026-03-05 09:30:00"),
        # another room between: rooms are paired separately
        _room("e1", "5", "ENTRY", "1A", "2026-03-05 10:00:00"),
        _room("e2", "5", "ENTRY", "1B", "2026-03-05 10:05:00"),
        _room("e3", "5", "EXIT", "1B", "2026-03-05 10:06:00"),
        _room("e4", "5", "EXIT", "1A", "2026-03-05 10:30:00"),
        # over midnight
        _room("f1", "6", "ENTRY", "2A", "2026-03-05 23:50:00"),
        _room("f2", "6", "EXIT", "2A", "2026-03-06 00:20:00"),
        # same second: event_id decides the order (g1 ENTRY before g2 EXIT)
        _room("g1", "7", "ENTRY", "2B", "2026-03-05 10:00:00"),
        _room("g2", "7", "EXIT", "2B", "2026-03-05 10:00:00"),
        # fractions of a second are floored before the difference
        _room("h1", "8", "ENTRY", "2C", "2026-03-05 10:00:00.900"),
        _room("h2", "8", "EXIT", "2C", "2026-03-05 10:01:00.100"),
    ]))
    got = {(r.student_id, r.room_id): r for r in R.room_durations(df).collect()}
    assert set(got) == {("1", "1A"), ("2", "1A"), ("5", "1A"), ("5", "1B"), ("6", "2A"), ("7", "2B"), ("8", "2C")}
    assert got[("1", "1A")].occupied_minutes == 45.5
    assert got[("2", "1A")].entry_time == dt.datetime(2026, 3, 5, 10, 10)
    assert got[("6", "2A")].record_date == dt.date(2026, 3, 5) and got[("6", "2A")].occupied_minutes == 30.0
    assert got[("7", "2B")].occupied_minutes == 0.0
    assert got[("8", "2C")].occupied_minutes == 1.0
    # the same input cut to one day (the latest-day job) loses the midnight stay
    day = df.filter(df.record_date == dt.date(2026, 3, 6))
    assert R.room_durations_daily(day).count() == 0


def _brute_force(data):
    """Reference pairing: sort each key's events, pair an ENTRY with a following EXIT."""
    out = []
    by_key = {}
    for r in data:
        by_key.setdefault((r[1], r[4]), []).append(r)
    for key, evs in by_key.items():
        evs.sort(key=lambda r: (r[5], r[0]))
        for a, b in zip(evs, evs[1:]):
            if a[2] == "ENTRY" and b[2] == "EXIT":
                out.append((a[1], a[4], a[0], a[5], b[5]))
    return sorted(out)


@pytest.mark.parametrize("buckets", [None, 1, 2, 7, 300])
def test_pairing_matches_brute_force_for_any_bucket(spark, events, buckets):
    rnd = random.Random(7)
    base = dt.datetime(2026, 3, 5, 8)
    data = []
    for i in range(600):
        student = rnd.choice(["1", "2", "3"]) if i % 5 else "hot"
        data.append((
            f"id{i:04d}", student, rnd.choice(["ENTRY", "EXIT"]), "ROOM_GATE", rnd.choice(["1A", "1B"]),
            base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400, 30)),
        ))
    df = with_record_date(events(data))
    got = pair_entries(df, range_partitions=buckets)
    assert rows(got, "student_id", "location", "event_id", "timestamp", "exit_timestamp") == _brute_force(data)
