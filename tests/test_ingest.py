import datetime as dt

from pyspark.sql import functions as F

from turnstile.operators.ingest import parse_events, route_events
from turnstile.schema import GATE_EVENT_NTZ

from conftest import rows

GOOD = '{"event_id":"e1","student_id":"2509600","event_type":"ENTRY","gate_type":"MAIN_GATE","location":"MAIN_HALL","timestamp":"2026-03-05T12:34:56"}'


def _payloads(spark, texts):
    return spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "value binary")


def test_parse_cases(spark):
    texts = [
        GOOD,
        "not json",
        "{}",
        '{"student_id":"1","event_type":"ENTRY"}',
        GOOD.replace("e1", "e2").replace("2026-03-05T12:34:56", "yesterday"),
        GOOD.replace("e1", "e3").replace("12:34:56", "12:34:56+08:00"),
        GOOD.replace("e1", "e4").replace("12:34:56", "12:34:56Z"),
        GOOD.replace('"e1"', "12345"),
        None,
    ]
    got = {r.event_id: r for r in parse_events(_payloads(spark, texts)).collect()}
    assert sorted(got) == ["12345", "e1", "e2", "e3", "e4"]
    assert got["e1"].timestamp == dt.datetime(2026, 3, 5, 12, 34, 56)
    assert got["e2"].timestamp is None and got["e2"].student_id == "2509600"
    assert got["e3"].timestamp == dt.datetime(2026, 3, 5, 4, 34, 56)  # +08:00 -> UTC
    assert got["e4"].timestamp == dt.datetime(2026, 3, 5, 12, 34, 56)


def test_parse_text_value_and_ntz(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    out = parse_events(df, GATE_EVENT_NTZ)
    assert dict(out.dtypes)["timestamp"] == "timestamp_ntz"
    assert out.first().timestamp == dt.datetime(2026, 3, 5, 12, 34, 56)


def test_route_by_gate(spark, events):
    df = events([
        ("a", "1", "ENTRY", "MAIN_GATE", "MAIN_HALL", "2026-03-05 08:00:00"),
        ("b", "1", "ENTRY", "ROOM_GATE", "1A", "2026-03-05 08:10:00"),
        ("c", "1", "ENTRY", "SIDE_GATE", "X", "2026-03-05 08:20:00"),
        ("d", "1", "ENTRY", None, "X", "2026-03-05 08:30:00"),
    ])
    routed = route_events(df)
    assert rows(routed.select("topic", F.get_json_object("value", "$.event_id").alias("id"))) == [
        ("main_gate_events", "a"), ("room_gate_events", "b"),
    ]
    back = parse_events(routed).select("event_id", "timestamp")
    assert rows(back) == [("a", dt.datetime(2026, 3, 5, 8)), ("b", dt.datetime(2026, 3, 5, 8, 10))]


def test_json_array_file_and_csv(spark, tmp_path):
    from turnstile.sources import read_events_json, read_students_csv

    path = tmp_path / "events.json"
    path.write_text(
        "[\n    {\n        \"event_id\": \"a\",\n        \"student_id\": \"1\",\n        \"event_type\": \"ENTRY\",\n"
        "        \"gate_type\": \"ROOM_GATE\",\n        \"location\": \"1A\",\n"
        "        \"timestamp\": \"2026-03-05T09:00:00\"\n    },\n"
        "    {\n        \"event_id\": \"b\",\n        \"student_id\": \"1\",\n        \"event_type\": \"EXIT\",\n"
        "        \"gate_type\": \"ROOM_GATE\",\n        \"location\": \"1A\",\n"
        "        \"timestamp\": \"2026-03-05T10:00:00\"\n    }\n]\n"
    )
    df = read_events_json(spark, str(path))
    assert [(r.event_id, r.timestamp) for r in df.orderBy("event_id").collect()] == [
        ("a", dt.datetime(2026, 3, 5, 9)), ("b", dt.datetime(2026, 3, 5, 10)),
    ]
    csv = tmp_path / "students.csv"
    csv.write_text("student_id,major,year_of_study,study_level\n2509600,Law,1,Postgraduate\n2509601,Data Science,x,Undergraduate\n")
    from turnstile.operators.graph import students_dim

    got = sorted(tuple(r) for r in students_dim(read_students_csv(spark, str(csv))).collect())
    assert got == [("2509600", "Law", 1, "Postgraduate"), ("2509601", "Data Science", None, "Undergraduate")]
