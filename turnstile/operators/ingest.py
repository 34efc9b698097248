"""Payload parsing and topic routing. Shared by batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.schema import GATE_EVENT, MAIN_GATE, ROOM_GATE, TOPIC_MAIN_GATE, TOPIC_ROOM_GATE

# JSON text keeps whole microseconds (Spark's default writes milliseconds only).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json_value(df: DataFrame) -> Column:
    """All columns of ``df`` as one JSON object."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_WRITE_OPTIONS)


def parse_events(df: DataFrame, schema: T.StructType = GATE_EVENT, value_col: str = "value") -> DataFrame:
    """JSON payload (binary or text) -> one typed event row.

    Permissive: a payload that is not JSON parses to all nulls and is dropped by the
    ``event_id`` check; a bad timestamp only nulls that field; numbers become text.
    """
    payload = F.col(value_col).cast("string")
    # The struct is produced by a generator: the ``event_id`` check cannot be pushed below
    # it, so each payload is parsed once (a plain projection gets the parse duplicated
    # into the pushed-down filter).
    return df.select(F.inline(F.array(F.from_json(payload, schema)))).filter(F.col("event_id").isNotNull())


#: Reasons of ``rejected_payloads``.
NO_PAYLOAD, NO_JSON, NO_EVENT_ID = "no payload", "not a JSON object", "no event_id"


def rejected_payloads(df: DataFrame, schema: T.StructType = GATE_EVENT, value_col: str = "value") -> DataFrame:
    """(value, reason): the payloads of which ``parse_events`` makes no event. Each payload is in one of the two."""
    payload = F.col(value_col).cast("string")
    unread = T.StructType([*schema.fields, T.StructField("_unread", T.StringType(), True)])
    parsed = F.from_json(payload, unread, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread"})
    # A generator, as in ``parse_events``: each payload is parsed once.
    rows = df.select(payload.alias("value"), F.inline(F.array(F.struct(parsed.alias("e")))))
    reason = (
        F.when(F.col("value").isNull(), NO_PAYLOAD)
        .when(F.col("e._unread").isNotNull() | F.col("e").isNull(), NO_JSON)
        .otherwise(NO_EVENT_ID)
    )
    return rows.filter(F.col("e.event_id").isNull()).select("value", reason.alias("reason"))


def route_events(
    df: DataFrame,
    main_topic: str = TOPIC_MAIN_GATE,
    room_topic: str = TOPIC_ROOM_GATE,
) -> DataFrame:
    """Event rows -> (topic, value) records for a Kafka writer; value is the event as JSON.

    Main-gate events go to one topic, room-gate events to the other; any other gate type
    (or none) is dropped.
    """
    topic = (
        F.when(F.col("gate_type") == MAIN_GATE, F.lit(main_topic))
        .when(F.col("gate_type") == ROOM_GATE, F.lit(room_topic))
    )
    return (
        df.select(topic.alias("topic"), to_json_value(df).alias("value"))
        .filter(F.col("topic").isNotNull())
    )
