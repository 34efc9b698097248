"""Readers: student CSV, JSON event files, curated Parquet, raw text log, Kafka (injected)."""

from turnstile.sources.files import (
    latest_partition,
    partition_days,
    partitions,
    read_curated,
    read_if_there,
    read_table,
    read_events_json,
    read_raw_log,
    read_students_csv,
)
from turnstile.sources.kafka import kafka_stream

__all__ = [
    "kafka_stream",
    "latest_partition",
    "partition_days",
    "partitions",
    "read_curated",
    "read_if_there",
    "read_table",
    "read_events_json",
    "read_raw_log",
    "read_students_csv",
]
