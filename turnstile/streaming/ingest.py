"""Stream ingest: one source, two independent queries with their own checkpoints.

* raw: every payload as one text line (bad ones too), append;
* curated: parsed events (bad JSON dropped), Parquet partitioned by date and gate.

Both resume from their checkpoint after a restart or a lost executor: the file sinks
commit a batch once, so a replayed micro-batch adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from turnstile.config import Settings
from turnstile.operators.ingest import parse_events, rejected_payloads
from turnstile.operators.keys import index_rows, key_bucket, read_keys, touched, unseen
from turnstile.operators.quality import dedupe_events, with_record_date
from turnstile.schema import GATE_EVENT
from turnstile.sinks import write_table
from turnstile.sources import read_if_there

CURATED_PARTITIONS = ("record_date", "gate_type")
STUDENT_SEEN = "student_id STRING, bucket INT, batch STRING"
CHECKPOINTS = "query STRING, number INT"


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def raw_query(
    source: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    writer = (
        source.select(F.col("value").cast("string").alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def curated_query(
    source: DataFrame,
    path: str,
    checkpoint: str,
    schema: T.StructType = GATE_EVENT,
    partition_by: tuple[str, ...] = CURATED_PARTITIONS,
    trigger: dict | None = None,
    name: str | None = None,
    copies_within: str | None = None,
) -> StreamingQuery:
    """Parsed events to Parquet. Partitioning by date as well as gate lets the latest-day
    job and date filters read only their directories.

    ``copies_within`` (an interval, "1 hour") leaves out copies of an id that arrive within that time of its first one. The
    watermark is on the time of arrival, not on the event's: an event that is late by its own time still
    lands, and a copy that arrives later is found by the batch as before. The state holds the ids of that time.
    """
    events = parse_events(source, schema)
    if copies_within:
        arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", copies_within)
        events = arrived.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")
    if "record_date" in partition_by:
        events = with_record_date(events)
    writer = (
        events.writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def rejects_query(
    source: DataFrame, path: str, checkpoint: str, schema: T.StructType = GATE_EVENT, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Payloads that the curated table does not take, with the reason, to Parquet by reason: what it has and the
    curated table has are together the raw log."""
    writer = (
        rejected_payloads(source, schema)
        .writeStream.format("parquet")
        .partitionBy("reason")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def start_ingest(
    source: DataFrame, settings: Settings, trigger: dict | None = None, copies_within: str | None = None
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both queries on one source frame (``kafka_stream`` in production)."""
    raw = raw_query(source, settings.raw, settings.checkpoint("raw"), trigger, "raw_events")
    curated = curated_query(
        source, settings.curated, settings.checkpoint("curated"), trigger=trigger, name="curated_events", copies_within=copies_within
    )
    return raw, curated


def run_stream(
    spark, settings: Settings, trigger: dict | None = None, upsert: bool = False, rejects: bool = False, copies_within: str | None = None
) -> None:
    """The long-running ingest: Kafka -> raw log + curated table (+ graph tables with ``upsert``, + the rejects table with
    ``rejects``), until a query stops. ``settings.max_offsets_per_trigger`` bounds each micro-batch, the first one too."""
    from turnstile.sources.kafka import kafka_stream

    source = kafka_stream(
        spark, settings.kafka_servers, settings.topics, max_offsets_per_trigger=settings.max_offsets_per_trigger
    )
    start_ingest(source, settings, trigger, copies_within)
    if rejects:
        rejects_query(source, settings.rejects, settings.checkpoint("rejects"), trigger=trigger, name="rejects")
    if upsert:
        upsert_query(source, settings, trigger)
    spark.streams.awaitAnyTermination()


def upsert_query(source: DataFrame, settings: Settings, trigger: dict | None = None) -> StreamingQuery:
    """Keep the graph's event tables up to date micro-batch by micro-batch."""
    writer = source.writeStream.foreachBatch(graph_upsert(settings)).queryName("graph_upsert")
    return _trigger(writer.option("checkpointLocation", settings.checkpoint("graph_upsert")), trigger).start()


def graph_upsert(settings: Settings, schema: T.StructType = GATE_EVENT):
    """A ``foreachBatch`` function that merges a micro-batch into the graph's event and student tables, which the
    whole-history job writes in the same layout.

    An event is known by its id alone: a copy stamped on another day adds nothing. Ids are looked up in the buckets of the
    index that the batch touches (``operators.keys``). Every table is partitioned by the batch that wrote its rows, and a
    batch that runs again after a failure overwrites its own partitions with the same rows.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_name(spark, settings, batch_id)
        events = with_record_date(parse_events(batch, schema)).filter(F.col("student_id").isNotNull())
        events = dedupe_events(events).withColumn("bucket", key_bucket("event_id", settings.key_buckets)).persist()
        try:
            known = read_keys(spark, settings.graph("event_keys"), touched(events, "bucket"), but=name)
            fresh = unseen(events.drop("bucket"), known, settings.key_buckets).persist()
            by_day = {"partition_by": ("record_date", "batch"), "mode": "overwrite", "dynamic": True}
            named = fresh.withColumn("batch", F.lit(name))
            write_table(
                named.select("event_id", "event_type", "gate_type", "location", "timestamp", "record_date", "batch"),
                settings.graph("v_event"), **by_day,
            )
            write_table(named.select("student_id", "event_id", "record_date", "batch"), settings.graph("e_performed"), **by_day)
            students = fresh.select("student_id").distinct().withColumn("bucket", key_bucket("student_id", settings.key_buckets))
            seen = read_if_there(spark, settings.graph("v_student_seen"), STUDENT_SEEN)
            seen = seen.filter(F.col("bucket").isin(touched(students, "bucket")) & (F.col("batch") != name))
            students = students.join(seen.select("bucket", "student_id"), ["bucket", "student_id"], "left_anti")
            by_bucket = {**by_day, "partition_by": ("bucket", "batch")}
            write_table(students.withColumn("batch", F.lit(name)), settings.graph("v_student_seen"), **by_bucket)
            write_table(index_rows(fresh, name, settings.key_buckets), settings.graph("event_keys"), **by_bucket)
            fresh.unpersist()
        finally:
            events.unpersist()

    return upsert


def batch_name(spark, settings: Settings, batch_id: int) -> str:
    """A name for a micro-batch that later ones follow in text order, and that it has again when it is run again.

    Batch numbers start over with a new checkpoint, so they are preceded by the number of the checkpoint: the place of
    its query's id in a list that has one row for each checkpoint ever used.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
    path = settings.path("checkpoints_seen")
    seen = {r["query"]: r["number"] for r in read_if_there(spark, path, CHECKPOINTS).collect()}
    if query not in seen:
        seen[query] = 1 + max(seen.values(), default=0)
        write_table(spark.createDataFrame([(query, seen[query])], CHECKPOINTS), path, mode="append")
    return f"{seen[query]:06d}-{batch_id:012d}"
