"""Rejected input, copies on the stream, compaction of closed days, and readers during a whole-history run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from turnstile.config import Settings
from turnstile.operators.ingest import NO_EVENT_ID, NO_JSON, NO_PAYLOAD, parse_events, rejected_payloads
from turnstile.operators.quality import with_record_date
from turnstile.plans import compaction, jobs, versions
from turnstile.schema import STUDENT_DIM
from turnstile.sinks import write_table
from turnstile.streaming import curated_query, raw_query, rejects_query

from conftest import rows
from test_streaming import TRIGGER, _drop, _event

BAD = ["not json", "{}", '{"event_id": null, "student_id": "s"}', "[1, 2", '{"event_id": "x", "timestamp": "soon"}', '"text"', "7", ""]


def test_rejects_and_events_are_all_payloads(spark):
    values = [_event(1), *BAD, None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    rejected = rejected_payloads(df)
    assert rejected.count() + parse_events(df).count() == len(values)
    reasons = {r.value: r.reason for r in rejected.collect()}
    assert reasons[None] == NO_PAYLOAD and reasons["not json"] == reasons["[1, 2"] == NO_JSON
    assert reasons["{}"] == reasons['{"event_id": null, "student_id": "s"}'] == NO_EVENT_ID
    assert not {_event(1), BAD[4]} & set(reasons)  # a bad timestamp alone is no reason
    assert rejected._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_rejects_on_the_stream(spark, tmp_path):
    inbox, settings = str(tmp_path / "inbox"), Settings(root=str(tmp_path / "lake"))
    _drop(inbox, "a.json", [_event(1), "not json", "{}", _event(2)])
    source = spark.readStream.format("text").load(inbox)
    for i in range(2):
        raw = raw_query(source, settings.raw, settings.checkpoint("raw"), TRIGGER)
        curated = curated_query(source, settings.curated, settings.checkpoint("curated"), trigger=TRIGGER)
        rejects = rejects_query(source, settings.rejects, settings.checkpoint("rejects"), trigger=TRIGGER)
        for query in (raw, curated, rejects):
            query.awaitTermination(120)
        n = spark.read.parquet(settings.rejects).count()
        assert n == 2 + i
        assert n + spark.read.parquet(settings.curated).count() == spark.read.text(settings.raw).count()
        _drop(inbox, "b.json", ["[", _event(3)])


def test_rejected_students(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("student_id,major,year_of_study,study_level\ns1,cs,2,UG\n,law,1,UG\ns3,law,soon,UG\ns4,law\ns5,a,1,UG,more\ns6,,,\n")
    settings = Settings(root=str(tmp_path / "lake"))
    jobs.land_students(spark, settings, str(path))
    assert rows(spark.read.parquet(settings.students), "student_id", "year_of_study") == [("s1", 2), ("s3", None), ("s4", None), ("s5", 1), ("s6", None)]
    reasons = {(r.student_id, r.reason) for r in spark.read.parquet(settings.students_rejects).collect()}
    assert reasons == {(None, "no student_id"), ("s3", "year is no number"), ("s4", "wrong number of fields"), ("s5", "wrong number of fields")}


def test_copies_on_the_stream(spark, tmp_path):
    """Copies that arrive soon are left out, across micro-batches and a restart; an event late by its own time lands."""
    inbox, settings = str(tmp_path / "inbox"), Settings(root=str(tmp_path / "lake"))

    def run(within):
        source = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(inbox)
        query = curated_query(source, settings.curated, settings.checkpoint("curated"), trigger=TRIGGER, copies_within=within)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r.event_id for r in spark.read.parquet(settings.curated).collect())

    _drop(inbox, "a.json", [_event(1), _event(1), _event(2)])
    _drop(inbox, "b.json", [_event(2), _event(3, when="2020-01-01T00:00:00"), _event(4, when="soon")])
    assert run("1 hour") == ["e1", "e2", "e3", "e4"]
    _drop(inbox, "c.json", [_event(1, when="2026-03-06T08:00:00"), _event(4, when="soon"), _event(5)])
    assert run("1 hour") == ["e1", "e2", "e3", "e4", "e5"]
    # A copy that came by anyway is found by the batch.
    from turnstile.operators.quality import clean_events_full

    again = spark.read.parquet(settings.curated)
    assert clean_events_full(again.unionByName(again), as_of="2026-03-10 00:00:00").count() == 4


def test_compaction_of_closed_days(spark, tmp_path):
    inbox, settings = str(tmp_path / "inbox"), Settings(root=str(tmp_path / "lake"))

    def land(name, lines):
        _drop(inbox, name, lines)
        source = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(inbox)
        curated_query(source, settings.curated, settings.checkpoint("curated"), trigger=TRIGGER).awaitTermination(120)

    def files(path):
        return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)

    def check():
        got, want = compaction.read_events(spark, settings), spark.read.parquet(settings.curated)
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols and rows(got, *cols) == rows(want, *cols)

    for i in range(4):
        land(f"{i}.json", [_event(10 * i, when="2026-03-05T08:00:00"), _event(10 * i + 1, "ROOM_GATE", "A", "2026-03-05T09:00:00"), _event(10 * i + 2, when="2026-03-06T08:00:00"), _event(10 * i + 3, when="soon")])
    check()
    closed, today = dt.date(2026, 3, 5), dt.date(2026, 3, 6)
    assert compaction.compact(spark, settings, today) == [closed]
    assert files(settings.compacted) == 2  # one a gate, eight before
    check()
    read = compaction.read_events(spark, settings).filter(F.col("record_date") == closed).inputFiles()
    assert compaction.compact(spark, settings, today) == [] and len(read) >= 2
    # The stream goes on; a late row of the closed day is seen at once and copied next time.
    land("late.json", [_event(99, when="2026-03-05T23:00:00"), _event(98, when="2026-03-07T08:00:00")])
    check()
    assert compaction.compact(spark, settings, dt.date(2026, 3, 7)) == [closed, today]
    check()


def test_a_failed_run_leaves_the_published_tables(spark, events, tmp_path, monkeypatch):
    settings = Settings(root=str(tmp_path / "lake"), key_buckets=2)
    data = [("a", "s1", "ENTRY", "ROOM_GATE", "A", "2026-03-05 09:00:00"), ("b", "s1", "EXIT", "ROOM_GATE", "A", "2026-03-05 10:00:00")]
    land = lambda some: write_table(with_record_date(events(some)), settings.curated, partition_by=("record_date", "gate_type"))
    write_table(spark.createDataFrame([("s1", "cs", 1, "UG")], STUDENT_DIM), settings.students)
    land(data)
    as_of = "2026-03-10 00:00:00"
    spark.sql("DROP DATABASE IF EXISTS gates CASCADE")
    try:
        assert versions.run_versioned(spark, settings, "gates", as_of) == 1
        answer = lambda: (rows(spark.table("gates.clean"), "event_id"), rows(spark.table("gates.report_room_durations"), "student_id"), rows(spark.table("gates.v_room")))
        before = answer()
        assert before == ([("a",), ("b",)], [("s1",)], [("A",)])
        land([*data[:1], ("c", "s1", "ENTRY", "ROOM_GATE", "B", "2026-03-06 09:00:00")])
        with monkeypatch.context() as m:
            m.setattr(jobs.G, "graph_tables", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                versions.run_versioned(spark, settings, "gates", as_of)
        assert answer() == before
        assert versions.run_versioned(spark, settings, "gates", as_of) == 2
        assert answer() == ([("a",), ("c",)], [], [("A",), ("B",)])
    finally:
        spark.sql("DROP DATABASE IF EXISTS gates CASCADE")
