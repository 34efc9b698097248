"""Kafka source. The connector jar is a deployment choice (spark-sql-kafka); it is not
loaded here, so tests hand the stream operators a file stream with the same ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnstile.schema import TOPIC_MAIN_GATE, TOPIC_ROOM_GATE


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: tuple[str, ...] = (TOPIC_MAIN_GATE, TOPIC_ROOM_GATE),
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to both gate topics from the earliest offset; ``value`` is the JSON event.

    ``max_offsets_per_trigger`` bounds a micro-batch when a backlog is replayed.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()
