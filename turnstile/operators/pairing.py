"""ENTRY -> EXIT pairing: for every event, the next event of the same (student, location).

A window over (student, location) would put every event of a key in one task; a stuck badge
or a replayed feed can make one key, or one key in one instant, a large share of all rows.
So the order is cut, not the keys: events are range-partitioned on (key, timestamp, event_id)
from a sample, which balances the tasks whatever the data, and the range is the bucket.

1. One window over each bucket, in that order, gives every event the next event. It is the
   only event-level window, evaluated once, and so is the bucket number.
2. Only the last event of a bucket lacks its next one: that is the first event of the next
   non-empty bucket. A second window over the bucket edges (two rows a bucket, whatever the
   number of events and keys) supplies it; the stays found inside buckets pass it by.

The result equals one ``lead`` over the whole key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.schema import ENTRY, EXIT


def pair_entries(
    df: DataFrame,
    keys: tuple[str, ...] = ("student_id", "location"),
    extra: tuple[str, ...] = ("record_date",),
    range_partitions: int | None = None,
) -> DataFrame:
    """Rows (keys, timestamp, event_id, event_type, extra) -> one row per ENTRY directly
    followed by an EXIT of the same key: keys, extra, ``timestamp``, ``exit_timestamp``.

    Order within a key is (timestamp, event_id), nulls last. ``range_partitions`` fixes the
    number of buckets; by default the session's shuffle partitions (AQE may join small ones).
    """
    keep = [*keys, *[c for c in extra if c not in keys], "timestamp", "event_id", "event_type"]
    order = [F.col(c).asc_nulls_last() for c in (*keys, "timestamp", "event_id")]
    events = df.select(*keep)
    ranged = events.repartitionByRange(*([range_partitions] if range_partitions else []), *order)
    bucketed = ranged.withColumn("_b", F.spark_partition_id())

    follower = F.struct(*keys, "timestamp", "event_type")
    in_bucket = Window.partitionBy("_b").orderBy(*order)
    events = bucketed.select(
        "*",
        F.lead(follower).over(in_bucket).alias("_next"),
        F.row_number().over(in_bucket).alias("_pos"),
    )
    last = F.col("_next").isNull()
    edge = last | (F.col("_pos") == 1)

    def opens_stay(after: str) -> Column:
        same_key = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{after}.{k}")) for k in keys])
        return (F.col("event_type") == ENTRY) & (F.col(f"{after}.event_type") == EXIT) & same_key

    # Stays inside a bucket stay spread by bucket; all edges form one small group.
    kept = events.filter(edge | opens_stay("_next")).withColumn("_group", F.when(edge, F.lit(-1)).otherwise(F.col("_b")))
    across = Window.partitionBy("_group").orderBy("_b", *order)
    found = kept.select("*", F.lead(follower).over(across).alias("_after"))
    found = found.withColumn("_exit", F.when(last, F.col("_after")).otherwise(F.col("_next")))
    out = [c for c in keep if c != "event_type"]
    return found.filter(opens_stay("_exit")).select(*out, F.col("_exit.timestamp").alias("exit_timestamp"))
