"""Increments against one run over everything: merges by id, redone days, stays across days, mergeable distinct counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from turnstile.config import Settings
from turnstile.operators.keys import key_bucket, newest, read_keys
from turnstile.operators.quality import with_record_date
from turnstile.operators.visitors import number_students
from turnstile.plans import increments as I
from turnstile.plans import jobs
from turnstile.schema import CLEAN_EVENT, STUDENT_DIM
from turnstile.sinks import replace_days, write_table
from turnstile.sources import latest_partition, partition_days, partitions

from conftest import rows

AS_OF = "2026-03-20 00:00:00"
CURATED = ("record_date", "gate_type")


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _land(df, settings):
    """Append to the curated table as the stream does."""
    write_table(with_record_date(df), settings.curated, partition_by=CURATED, mode="append")


def _students(spark, settings, n=4):
    data = [(f"s{i}", ("cs", "law", None)[i % 3], i % 2 + 1, "UG") for i in range(n)]
    write_table(spark.createDataFrame(data, STUDENT_DIM), settings.students)


def _random_events(rng, n):
    """Ids that repeat with other times, days and students; a few rows ahead of time or without a student."""
    out = []
    for _ in range(n):
        i = rng.randrange(n // 2)
        when = dt.datetime(2026, 3, 1) + dt.timedelta(days=rng.randrange(6), minutes=30 * rng.randrange(48))
        if rng.random() < 0.05:
            when += dt.timedelta(days=30)
        room = rng.random() < 0.7
        out.append((
            f"e{i}", None if rng.random() < 0.05 else f"s{rng.randrange(4)}", rng.choice(["ENTRY", "EXIT"]),
            "ROOM_GATE" if room else "MAIN_GATE", rng.choice("AB") if room else "MAIN_HALL", when,
        ))
    return out


REPORTS = ("hourly_traffic", "daily_rooms", "hourly_room_usage", "room_durations")


def _state(spark, settings):
    tables = {name: spark.read.parquet(settings.report(name)) for name in REPORTS}
    tables["clean"] = spark.read.schema(CLEAN_EVENT).parquet(settings.clean)
    return {name: rows(df, *sorted(df.columns)) for name, df in tables.items()}


def test_increments_equal_one_run(spark, events, tmp_path):
    """A whole-history run, then increments with late copies, copies of other days and rows ahead of their time."""
    rng = random.Random(1)
    data = _random_events(rng, 120)
    whole, steps = Settings(root=str(tmp_path / "whole")), Settings(root=str(tmp_path / "steps"), key_buckets=4)
    for settings in (whole, steps):
        _students(spark, settings)
    _land(events(data[:60]), steps)
    jobs.run_full_batch(spark, steps, as_of=AS_OF, with_graph=False)
    _land(events(data[60:]), steps)
    I.run_increment(spark, steps, as_of=AS_OF)
    before = jobs.keys_path(spark, steps)
    assert not I.fold_keys(spark, steps) and I.fold_keys(spark, steps, batches=1)
    assert jobs.keys_path(spark, steps) != before
    # A later look: what was ahead of its time counts now.
    late = [("late", "s1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-02 08:00:00")]
    _land(events(late), steps)
    I.run_increment(spark, steps, as_of="2026-05-01 00:00:00")
    _land(events(data + late), whole)
    jobs.run_full_batch(spark, whole, as_of="2026-05-01 00:00:00", with_graph=False)
    want = _state(spark, whole)
    assert all(want.values())
    assert _state(spark, steps) == want
    # The questions from the daily table, with a cut-off inside a day and at midnight.
    for as_of in ("2026-03-06 10:00:00", "2026-03-06 00:00:00"):
        events_based = jobs.analytics(spark, whole, as_of, 3)
        for name, df in I.questions_from_daily(spark, steps, as_of, 3).items():
            assert rows(df, *sorted(df.columns)) == rows(events_based[name], *sorted(df.columns)), name


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_increments_in_any_order(spark, events, seed):
    """The clean table after three increments, whichever comes first."""
    from functools import reduce

    from turnstile.operators.increments import changed_copies, due, located, redone
    from turnstile.operators.keys import index_rows
    from turnstile.operators.quality import clean_events_full

    rng = random.Random(seed)
    data = _random_events(rng, 200)
    parts = [events(data[i::3]) for i in range(3)]
    rng.shuffle(parts)

    def step(clean, part):
        changed = changed_copies(located(due(part, AS_OF)[0], index_rows(clean, "1")), clean)
        return spark.createDataFrame(redone(clean, changed).collect(), CLEAN_EVENT)

    clean = reduce(step, parts, spark.createDataFrame([], CLEAN_EVENT))
    want = rows(clean_events_full(events(data), as_of=AS_OF), *CLEAN_EVENT.fieldNames())
    assert want and rows(clean, *CLEAN_EVENT.fieldNames()) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_days_paired_one_by_one(spark, events, seed):
    """Stays over midnight and over days without events; entries that are never closed."""
    from turnstile.operators.carry import closed_stays, open_entries
    from turnstile.operators.reports import room_durations

    rng = random.Random(seed)
    clean = with_record_date(events([(f"u{i}", *e[1:]) for i, e in enumerate(_random_events(rng, 90)) if e[1] and e[5].month == 3 and e[5].day < 8]))
    days = sorted(r[0] for r in clean.select("record_date").distinct().collect())
    before, got = None, []
    for day in days:
        today = clean.filter(F.col("record_date") == F.lit(day))
        stays = closed_stays(today, before)
        got += rows(stays.drop("closed_date"))
        assert all(d == day for (d,) in rows(stays, "closed_date"))
        opened = open_entries(today, before, [day])
        before = spark.createDataFrame(opened.collect(), opened.schema)
    assert sorted(got, key=repr) == rows(room_durations(clean, ordered=False))
    # All days at once give the entries open at the end of each.
    at_once = open_entries(clean, None, days)
    assert rows(at_once.filter(F.col("open_date") == F.lit(days[-1]))) == rows(before)


def test_increment_that_fails_half_way(spark, events, tmp_path, monkeypatch):
    rng = random.Random(7)
    data = _random_events(rng, 80)
    whole, steps = Settings(root=str(tmp_path / "whole")), Settings(root=str(tmp_path / "steps"), key_buckets=4)
    for settings in (whole, steps):
        _students(spark, settings)
    _land(events(data), whole)
    jobs.run_full_batch(spark, whole, as_of=AS_OF, with_graph=False)
    _land(events(data[:40]), steps)
    I.run_increment(spark, steps, as_of=AS_OF)
    _land(events(data[40:]), steps)
    for step in ("replace_days", "refresh_reports", "refresh_visits"):
        with monkeypatch.context() as m:
            def fail(*_, **__):
                raise RuntimeError("lost")

            m.setattr(I, step, fail)
            with pytest.raises(Exception, match="lost"):
                I.run_increment(spark, steps, as_of=AS_OF)
    I.run_increment(spark, steps, as_of=AS_OF)
    assert _state(spark, steps) == _state(spark, whole)
    index = newest(read_keys(spark, jobs.keys_path(spark, steps), list(range(4))))
    assert rows(index, "event_id", "record_date") == rows(spark.read.parquet(whole.clean), "event_id", "record_date")


def test_daily_rerun_leaves_no_stale_day(spark, events, tmp_path):
    settings = Settings(root=str(tmp_path / "lake"))
    stay = [("r1", "s1", "ENTRY", "ROOM_GATE", "A", "2026-03-05 09:00:00"), ("r2", "s1", "EXIT", "ROOM_GATE", "A", "2026-03-05 10:00:00")]
    day = dt.date(2026, 3, 5)
    write_table(with_record_date(events(stay)), settings.curated, partition_by=CURATED)
    jobs.run_daily_batch(spark, settings)
    durations = lambda: spark.read.schema("room_id string, record_date date").parquet(settings.report("room_durations"))
    assert durations().count() == 1
    # The exit is withdrawn: the day has events and no stay.
    write_table(with_record_date(events(stay[:1])), settings.curated, partition_by=CURATED)
    jobs.run_daily_batch(spark, settings)
    assert durations().count() == 0
    assert spark.read.parquet(settings.report("daily_rooms")).count() == 1
    # All of the day is withdrawn: it is run again by its name, and an earlier day stays.
    write_table(with_record_date(events([("x", "s1", "ENTRY", "ROOM_GATE", "A", "2026-03-04 09:00:00")])), settings.curated, partition_by=CURATED)
    jobs.run_daily_batch(spark, settings)
    jobs.run_daily_batch(spark, settings, day=day)
    assert rows(spark.read.parquet(settings.report("daily_rooms")), "record_date", "total_room_entries") == [(dt.date(2026, 3, 4), 1)]


def test_replace_days_keeps_other_days_and_odd_names(spark, tmp_path):
    path = str(tmp_path / "t")
    d = [dt.date(2026, 3, i) for i in range(1, 4)]
    make = lambda data: spark.createDataFrame(data, "record_date date, gate string, x int")
    write_table(make([(d[0], "a/b=c %", 1), (d[0], "é", 2), (d[0], None, 3), (d[1], "g", 4)]), path, partition_by=("record_date", "gate"))
    replace_days(make([(d[0], "é", 9)]), path, [d[0], d[2]], partition_by=("record_date", "gate"))
    got = spark.read.schema("x int, record_date date, gate string").parquet(path)
    assert rows(got, "record_date", "gate", "x") == [(d[0], "é", 9), (d[1], "g", 4)]
    replace_days(make([]), path, [d[1]], partition_by=("record_date", "gate"))
    assert rows(spark.read.schema("x int, record_date date, gate string").parquet(path), "x") == [(9,)]
    replace_days(make([]), path, [])


def _event(i, when, student="s1"):
    return f'{{"event_id": "e{i}", "student_id": "{student}", "event_type": "ENTRY", "gate_type": "MAIN_GATE", "location": "MAIN_HALL", "timestamp": "{when}"}}'


def test_merge_is_by_id_alone(spark, tmp_path):
    from turnstile.streaming import graph_upsert

    settings = Settings(root=str(tmp_path / "lake"), key_buckets=8)
    upsert = graph_upsert(settings)
    batch = lambda *values: spark.createDataFrame([(v,) for v in values], "value string")
    upsert(batch(_event(1, "2026-03-05T08:00:00")), 0)
    upsert(batch(_event(1, "2026-03-09T08:00:00", "s2"), _event(2, "2026-03-09T08:00:00", "s2")), 1)
    stored = spark.read.parquet(settings.graph("v_event"))
    assert rows(stored, "event_id", "record_date") == [("e1", dt.date(2026, 3, 5)), ("e2", dt.date(2026, 3, 9))]
    assert rows(spark.read.parquet(settings.graph("e_performed")), "event_id", "student_id") == [("e1", "s1"), ("e2", "s2")]
    # Students of the stream are student vertices, with what the dimension knows of them.
    _students(spark, settings)
    assert ("s2", None, 1) in rows(jobs.graph_students(spark, settings)) and len(rows(jobs.graph_students(spark, settings))) == 2


def test_merge_reads_the_touched_buckets_only(spark, tmp_path):
    from turnstile.operators.keys import index_rows

    path = str(tmp_path / "keys")
    ids = spark.range(200).select(F.col("id").cast("string").alias("event_id"), F.lit("2026-03-05").cast("date").alias("record_date"))
    write_table(index_rows(ids, "0", 16), path, partition_by=("bucket", "batch"))
    wanted = [r[0] for r in ids.limit(2).select(key_bucket("event_id", 16)).collect()]
    known = read_keys(spark, path, wanted, but="1")
    (scan,) = [line for line in known._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
    assert "bucket#" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    folders = {f.split("bucket=")[1].split("/")[0] for f in known.inputFiles()}
    assert {r[0] for r in known.select("bucket").distinct().collect()} == set(wanted)
    read = known._jdf.queryExecution().executedPlan().collectLeaves().head().relation().location()
    assert len(folders) == 16 and read is not None  # the table has all, the filter names the wanted ones
    files = {r[0].split("bucket=")[1].split("/")[0] for r in known.select(F.input_file_name()).distinct().collect()}
    assert files == {str(b) for b in wanted}


def test_latest_day_opens_no_file(spark, events, tmp_path):
    path = str(tmp_path / "curated")
    data = [("a", "s", "ENTRY", "MAIN_GATE", "M", "2026-03-04 08:00:00"), ("b", "s", "EXIT", "MAIN_GATE", "M", "2026-03-06 08:00:00"), ("c", "s", "EXIT", "MAIN_GATE", "M", None)]
    df = with_record_date(events(data))
    write_table(df, path, partition_by=CURATED)
    assert partition_days(spark, path) == [dt.date(2026, 3, 6), dt.date(2026, 3, 4)]
    assert latest_partition(spark, path, df.schema) == dt.date(2026, 3, 6)
    # Files that are no Parquet at all: the days still come from the directories.
    for i, folder in enumerate(("record_date=2026-04-01/gate_type=MAIN_GATE", "record_date=2026-04-02/gate_type=X%3AY")):
        (tmp_path / "curated" / folder).mkdir(parents=True)
        (tmp_path / "curated" / folder / f"part-0000{i}.parquet").write_bytes(b"not parquet")
    assert partition_days(spark, path)[0] == dt.date(2026, 4, 2)
    assert (dt.date(2026, 4, 2), "X:Y") in partitions(spark, path, "record_date DATE, gate_type STRING")
    # A day whose files have no rows is passed over.
    empty = str(tmp_path / "empty")
    write_table(df, empty, partition_by=("record_date",))
    write_table(df.filter("false").drop("record_date"), f"{empty}/record_date=2026-05-01")
    assert latest_partition(spark, empty, df.schema) == dt.date(2026, 3, 6)
    assert latest_partition(spark, str(tmp_path / "none"), df.schema) is None
    assert spark.conf.get("spark.sql.optimizer.metadataOnly") == "false"


def test_student_numbers_have_no_gaps(spark):
    first = number_students(spark.range(100).select(F.col("id").cast("string").alias("student_id")), buckets=7)
    numbers = dict(rows(first))
    assert sorted(numbers.values()) == list(range(1, 101))
    more = spark.range(90, 130).select(F.col("id").cast("string").alias("student_id"))
    after = dict(rows(number_students(more.unionByName(more), first, buckets=7)))
    assert sorted(after.values()) == list(range(1, 131))
    assert all(after[k] == v for k, v in numbers.items())
    assert rows(number_students(more.filter("false"))) == []
