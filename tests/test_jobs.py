import os

from turnstile.config import Settings
from turnstile.plans import jobs
from turnstile.sinks import write_table
from turnstile.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _lake(spark, tmp_path):
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    # curated table laid out as the stream writes it
    dirty = fx.gate_events_dirty(spark, SF)
    from turnstile.operators.quality import with_record_date

    write_table(with_record_date(dirty), settings.curated, partition_by=("record_date", "gate_type"))
    csv = str(tmp_path / "students_csv")
    fx.students(spark, SF).write.option("header", True).csv(csv)
    jobs.land_students(spark, settings, csv)
    return settings


def _snapshot(spark, path):
    df = spark.read.parquet(path)
    return sorted(map(lambda r: tuple(map(str, r)), df.select(*sorted(df.columns)).collect()))


def test_full_then_daily_twice_is_idempotent(spark, tmp_path):
    settings = _lake(spark, tmp_path)
    jobs.run_full_batch(spark, settings, as_of="2024-01-28 00:00:00")
    first = {n: _snapshot(spark, settings.report(n)) for n in ("hourly_traffic", "daily_rooms", "hourly_room_usage")}

    jobs.run_daily_batch(spark, settings)
    once = {n: _snapshot(spark, settings.report(n)) for n in first}
    jobs.run_daily_batch(spark, settings)
    twice = {n: _snapshot(spark, settings.report(n)) for n in first}
    assert once == twice  # re-running a day replaces that day

    # one schema per table whichever job wrote the partition
    hourly = spark.read.parquet(settings.report("hourly_traffic"))
    assert set(hourly.columns) == {"record_date", "record_hour", "total_hourly_entries", "total_hourly_exits"}
    days = {r.record_date.isoformat() for r in hourly.select("record_date").distinct().collect()}
    assert "2024-01-30" in days and "2024-01-27" in days  # the daily run added its day, kept the rest
    # days the full run wrote are untouched
    assert [r for r in once["daily_rooms"] if "2024-01-30" not in r] == [
        r for r in first["daily_rooms"] if "2024-01-30" not in r
    ]

    jobs.run_full_batch(spark, settings, as_of="2024-01-28 00:00:00")
    assert {n: _snapshot(spark, settings.report(n)) for n in first} == first  # full run replaces all

    for name in ("v_student", "v_event", "e_entered", "e_studied_in", "v_library"):
        assert os.path.isdir(settings.graph(name))
    out = jobs.analytics(spark, settings, as_of="2024-01-31 00:00:00", trailing_days=7)
    assert out["peak_hours"].count() == 5
    assert out["visit_summary"].first().total_entries > 0


def test_written_reports_equal_the_oracle(spark, tmp_path):
    """The production path (curated table -> clean table -> reports written by date) gives
    the same rows as the registered queries' SQL on the same input."""
    import datetime as dt

    import duckdb

    import __spark_entry__ as E

    settings = _lake(spark, tmp_path)
    jobs.run_full_batch(spark, settings, as_of="2024-01-28 00:00:00", with_graph=False)
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")

    def norm(v):
        return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v

    for table, key in (
        ("hourly_traffic", "hourly_gate_traffic_full"),
        ("daily_rooms", "daily_room_usage_full"),
        ("hourly_room_usage", "hourly_room_usage_full"),
        ("room_durations", "room_durations_full"),
    ):
        res = con.execute(E.oracle_sql()[key])
        cols = [d[0] for d in res.description]
        want = sorted((tuple(norm(v) for v in r) for r in res.fetchall()), key=repr)
        got_df = spark.read.parquet(settings.report(table)).select(*cols)
        got = sorted((tuple(norm(v) for v in r) for r in got_df.collect()), key=repr)
        assert got == want, table


def test_daily_partitions_equal_the_daily_oracle(spark, tmp_path):
    import datetime as dt

    import duckdb
    from pyspark.sql import functions as F

    from turnstile.plans import catalog as C

    settings = _lake(spark, tmp_path)
    jobs.run_full_batch(spark, settings, as_of="2024-01-28 00:00:00", with_graph=False)
    jobs.run_daily_batch(spark, settings)
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    day = dt.date(2024, 1, 30)
    tables = {n: spark.read.parquet(settings.report(n)).filter(F.col("record_date") == day)
              for n in ("hourly_traffic", "daily_rooms", "hourly_room_usage", "room_durations")}
    views = {n: spark.read.parquet(settings.report(f"daily/{n}")) for n in ("hourly_traffic", "hourly_room_usage")}
    # (frame, sql, must have rows): this view has no latest-day stays at sf0.001
    checks = (
        (views["hourly_traffic"], C.with_views(C.CTE_DIRTY_DAILY, C._HOURLY_GATE_DAILY), True),
        (tables["daily_rooms"], C.with_views(C.CTE_DIRTY_DAILY, C._DAILY_ROOM), True),
        (views["hourly_room_usage"], C.with_views(C.CTE_DIRTY_DAILY, C._HOURLY_ROOM_DAILY), True),
        (tables["room_durations"], C._durations_sql(C.CTE_DIRTY_DAILY), False),
    )

    def norm(v):
        return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v

    for df, sql, non_empty in checks:
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        want = sorted((tuple(norm(v) for v in r) for r in res.fetchall()), key=repr)
        got = sorted((tuple(norm(v) for v in r) for r in df.select(*cols).collect()), key=repr)
        assert got == want, cols
        assert want or not non_empty, cols


def test_written_graph_tables_equal_the_oracle(spark, tmp_path):
    import datetime as dt

    import duckdb

    from turnstile.plans import catalog as C
    from turnstile.plans.oracle import durations_cte

    settings = _lake(spark, tmp_path)
    jobs.run_full_batch(spark, settings, as_of="2024-01-28 00:00:00")
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    base = C.CTE_DIRTY_FULL
    checks = {
        "v_student": C.with_views(base, C._V_STUDENT),
        "v_event": C.with_views(base, "SELECT event_id, event_type, gate_type, location, timestamp FROM clean"),
        "e_entered": C.with_views(base, "SELECT DISTINCT student_id, location FROM clean WHERE gate_type = 'ROOM_GATE'"),
        "v_library": C.with_views(base, "SELECT DISTINCT 'Main Library' AS name FROM clean"),
        "e_studied_in": C.with_views(base + [("durations", durations_cte("clean"))], C._E_STUDIED_IN),
    }

    def norm(v):
        return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v

    for table, sql in checks.items():
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        want = sorted((tuple(norm(v) for v in r) for r in res.fetchall()), key=repr)
        got_df = spark.read.parquet(settings.graph(table)).select(*cols)
        got = sorted((tuple(norm(v) for v in r) for r in got_df.collect()), key=repr)
        assert got == want and want, table


QUESTIONS = ("top5_rooms_by_major_year", "daily_visits_by_period", "visit_summary", "peak_hours", "popular_rooms")


def _event_rows(rows):
    """(event_id, student, type, gate, location, time) as the curated columns."""
    return [dict(zip(("event_id", "student_id", "event_type", "gate_type", "location", "timestamp"), r)) for r in rows]


def test_daily_leaves_the_questions_alone(spark, events, tmp_path):
    """An id on both sides of midnight and a row dated 2099 change no answer."""
    from turnstile.operators.quality import with_record_date

    data = [(f"m{i}", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 08:00:00") for i in range(3)]
    data += [("twice", "2", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 23:59:00"), ("twice", "2", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-06 00:01:00")]
    data += [("late", "2", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2099-01-01 00:00:00")]
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    write_table(with_record_date(events(data)), settings.curated, partition_by=("record_date", "gate_type"))
    csv = str(tmp_path / "csv")
    spark.createDataFrame([("1", "cs", "2", "UG")], "student_id string, major string, year_of_study string, study_level string").write.option("header", True).csv(csv)
    jobs.land_students(spark, settings, csv)
    as_of = "2026-03-10 00:00:00"
    jobs.run_full_batch(spark, settings, as_of=as_of)
    answers = lambda: {n: _rows(df) for n, df in jobs.analytics(spark, settings, as_of=as_of).items()}
    _rows = lambda df: sorted(map(str, df.collect()))
    before = answers()
    assert set(before) == set(QUESTIONS) and "total_entries=4" in before["visit_summary"][0]
    jobs.run_daily_batch(spark, settings)
    assert answers() == before
    assert [r.event_id for r in spark.read.parquet(settings.clean_daily).collect()] == ["late"]


def test_no_events_no_stays_and_main_gate_only(spark, events, tmp_path):
    from turnstile.operators.quality import with_record_date

    main = [("m1", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 08:00:00")]
    no_stay = [*main, ("r1", "1", "ENTRY", "ROOM_GATE", "A", "2026-03-05 09:00:00")]
    for name, data in (("none", []), ("main", main), ("no_stay", no_stay)):
        settings = Settings(key_buckets=4, root=str(tmp_path / name))
        write_table(with_record_date(events(data)), settings.curated, partition_by=("record_date", "gate_type"))
        write_table(spark.createDataFrame([], "student_id string, major string, year_of_study int, study_level string"), settings.students)
        for _ in range(2):
            jobs.run_full_batch(spark, settings, as_of="2026-03-10 00:00:00")
            jobs.run_daily_batch(spark, settings)
            jobs.run_analytics(spark, settings, as_of="2026-03-10 00:00:00")
        assert spark.read.parquet(settings.path("analytics/visit_summary")).first().total_entries == len(data[:1])
        assert spark.read.schema("name string").parquet(settings.graph("v_library")).count() == len(data[:1])
