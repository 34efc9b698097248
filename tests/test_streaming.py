import json
import os

from turnstile.config import Settings
from turnstile.streaming import graph_upsert, start_ingest

TRIGGER = {"availableNow": True}


def _event(i, gate="MAIN_GATE", loc="MAIN_HALL", when="2026-03-05T08:00:00"):
    return json.dumps({"event_id": f"e{i}", "student_id": str(2509600 + i % 3), "event_type": "ENTRY",
                       "gate_type": gate, "location": loc, "timestamp": when})


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}.tmp")
    with open(tmp, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(tmp, os.path.join(folder, name))  # atomic arrival of a whole file


def _run(spark, inbox, settings):
    source = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(inbox)
    raw, curated = start_ingest(source, settings, trigger=TRIGGER)
    raw.awaitTermination(120)
    curated.awaitTermination(120)
    assert raw.exception() is None and curated.exception() is None


def test_stream_raw_and_curated_with_restart(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    _drop(inbox, "a.json", [_event(1), _event(2, "ROOM_GATE", "1A"), "not json", _event(3, when="2026-03-06T09:00:00")])
    _run(spark, inbox, settings)

    raw = spark.read.text(settings.raw)
    assert raw.count() == 4  # the raw log keeps the bad payload
    curated = spark.read.parquet(settings.curated)
    assert sorted(r.event_id for r in curated.collect()) == ["e1", "e2", "e3"]
    parts = {os.path.basename(p) for p in os.listdir(settings.curated) if not p.startswith("_")}
    assert parts == {"record_date=2026-03-05", "record_date=2026-03-06"}

    # restart: nothing new, nothing added
    _run(spark, inbox, settings)
    assert spark.read.text(settings.raw).count() == 4
    assert spark.read.parquet(settings.curated).count() == 3

    # a new file adds only its own rows
    _drop(inbox, "b.json", [_event(4), _event(5, "SIDE_GATE", "X")])
    _run(spark, inbox, settings)
    assert spark.read.text(settings.raw).count() == 6
    assert sorted(r.event_id for r in spark.read.parquet(settings.curated).collect()) == ["e1", "e2", "e3", "e4", "e5"]


def test_batch_parse_equals_stream_parse(spark, tmp_path):
    from turnstile.operators.ingest import parse_events

    inbox = str(tmp_path / "inbox")
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    lines = [_event(i, "ROOM_GATE" if i % 2 else "MAIN_GATE", "1A" if i % 2 else "MAIN_HALL") for i in range(20)]
    _drop(inbox, "a.json", lines + ["{}", "[1,2"])
    _run(spark, inbox, settings)
    batch = parse_events(spark.read.text(inbox))
    stream = spark.read.parquet(settings.curated).select(*batch.columns)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect()))


def test_graph_upsert_replay_adds_nothing(spark, tmp_path):
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    upsert = graph_upsert(settings)
    batch = spark.createDataFrame([(_event(1),), (_event(2),), (_event(1),)], "value string")
    upsert(batch, 0)
    upsert(batch, 0)  # the same micro-batch again after a failure
    upsert(spark.createDataFrame([(_event(3),), (_event(2),)], "value string"), 1)
    assert sorted(r.event_id for r in spark.read.parquet(settings.graph("v_event")).collect()) == ["e1", "e2", "e3"]
    assert spark.read.parquet(settings.graph("e_performed")).count() == 3
    assert spark.read.parquet(settings.graph("v_student_seen")).count() == 3


def test_upsert_of_a_bad_timestamp_is_idempotent(spark, tmp_path):
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    upsert = graph_upsert(settings)
    batch = spark.createDataFrame([(_event(1, when="soon"),), (_event(2),)], "value string")
    for _ in range(3):
        upsert(batch, 0)
    assert sorted(r.event_id for r in spark.read.parquet(settings.graph("v_event")).collect()) == ["e1", "e2"]
    assert spark.read.parquet(settings.graph("e_performed")).count() == 2


def test_full_and_upsert_share_their_tables(spark, tmp_path):
    """full -> upsert -> full -> upsert on one root, the upsert as a stream job."""
    from turnstile.plans import jobs
    from turnstile.sinks import write_table
    from turnstile.streaming import upsert_query

    inbox = str(tmp_path / "inbox")
    settings = Settings(key_buckets=4, root=str(tmp_path / "lake"))
    write_table(spark.createDataFrame([], "student_id string, major string, year_of_study int, study_level string"), settings.students)
    ids = lambda: sorted(r.event_id for r in spark.read.parquet(settings.graph("v_event")).collect())
    seen = []
    for i in (1, 2):
        _drop(inbox, f"{i}.json", [_event(i), _event(i + 10, "ROOM_GATE", "A")])
        _run(spark, inbox, settings)
        jobs.run_full_batch(spark, settings, as_of="2026-03-10 00:00:00")
        seen += [f"e{i}", f"e{i + 10}"]
        assert ids() == sorted(seen)
        _drop(inbox, f"{i}x.json", [_event(i), _event(i + 20)])  # one known, one new
        query = upsert_query(spark.readStream.format("text").load(inbox), settings, trigger=TRIGGER)
        query.awaitTermination(120)
        assert query.exception() is None
        assert ids() == sorted([*seen, f"e{i + 20}"])
        seen.append(f"e{i + 20}")
    assert spark.read.parquet(settings.graph("e_performed")).count() == len(seen)
