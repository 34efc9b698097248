"""Plan shape: pruning reaches the scan, dedupe limits before the shuffle, one JSON parse,
the pairing window is split by time bucket."""

import re

from pyspark.sql import functions as F

from turnstile.operators import reports as R
from turnstile.operators.ingest import parse_events
from turnstile.operators.quality import clean_events_full, with_record_date
from turnstile.sinks import write_table
from turnstile.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df):
    return [line for line in _plan(df).split("\n") if "FileScan" in line]


def test_reports_prune_gate_and_date_partitions(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_table(with_record_date(fx.gate_events(spark, SF)), path, partition_by=("record_date", "gate_type"))
    clean = spark.read.parquet(path)
    (scan,) = _scans(R.hourly_gate_traffic_full(clean, ordered=False))
    assert "(gate_type#" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<event_type:string,timestamp:timestamp_ntz>" in scan

    latest = clean.select(F.max("record_date")).scalar()
    day = R.daily_room_usage(clean.filter(F.col("record_date") == latest), ordered=False)
    main_scan = [s for s in _scans(day) if "event_type" in s][0]
    assert "Subquery" in main_scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "EqualTo(event_type,ENTRY)" in main_scan


def test_validity_filters_reach_the_scan(spark):
    clean = clean_events_full(fx.gate_events(spark, SF), as_of="2024-01-28 00:00:00")
    scan = _scans(clean)[0]
    assert "LessThanOrEqual(ts,2024-01-28T00:00)" in scan


def test_dedupe_limits_before_shuffle(spark):
    plan = _plan(clean_events_full(fx.gate_events_dirty(spark, SF), as_of="2024-01-28 00:00:00"))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial limit sits below the exchange on event_id
    exchange = plan.index("Exchange hashpartitioning(event_id")
    assert plan.index("Partial", exchange) > exchange


def test_payload_parsed_once(spark):
    df = spark.createDataFrame([('{"event_id":"a"}',)], "value string")
    assert _plan(parse_events(df)).count("from_json(") == 1


def test_pairing_has_one_event_level_window(spark):
    clean = clean_events_full(fx.gate_events(spark, SF), as_of="2024-01-31 00:00:00")
    plan = _plan(R.room_durations(clean, ordered=False))
    pairing = plan[: plan.index("rangepartitioning(student_id")]
    # Above the range exchange: one window over the bucket, one over what it kept (stays and bucket edges).
    assert re.findall(r"windowspecdefinition\((_b|_group)#", pairing).count("_b") >= 1
    windows = [line for line in pairing.split("\n") if re.search(r"\bWindow\b ", line) or "+- Window " in line]
    assert len(windows) == 2, plan
    assert plan.count("rangepartitioning(student_id") == 1  # evaluated once
    assert "Union" not in pairing


def test_summary_counts_distincts_of_a_small_table(spark):
    from turnstile.operators.analytics import visit_summary

    plan = _plan(visit_summary(with_record_date(fx.gate_events(spark, SF))))
    scan = plan.index("FileScan")
    assert "Expand" not in plan[plan.rindex("hashpartitioning(student_id") : scan]  # none over the events


def test_library_reads_one_row_and_shuffles_nothing(spark):
    from turnstile.operators.graph import v_library
    from turnstile.operators.quality import valid_events

    plan = _plan(v_library(valid_events(fx.gate_events(spark, SF), as_of="2024-01-31 00:00:00")))
    assert "hashpartitioning" not in plan and "LocalLimit 1" in plan or "CollectLimit 1" in plan


def test_no_broadcast_hints(spark):
    from turnstile.plans import catalog

    for name, build in catalog.queries().items():
        logical = build(spark, SF)._jdf.queryExecution().logical().toString()
        assert "broadcast" not in logical.lower(), name
