"""An index of keys that have been merged, dealt into buckets by a hash of the key.

A batch reads only the buckets that its own keys fall into: the bucket is a partition column, and the list of touched buckets
(at most ``buckets`` numbers) is a literal of the filter, so that the other directories are not listed. An index row
also names the day under which the key's event is stored, so that its copy is found without reading other days.

Rows carry the ``batch`` that wrote them, a partition column too. A batch that is run again after a failure overwrites
its own partitions and does not see them as known, so it writes the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.schema import KEY_INDEX

BUCKETS = 64
#: Batch name of a whole-history run. Names are compared as text: it comes before all others.
FULL = "0"


def key_bucket(key: str = "event_id", buckets: int = BUCKETS) -> Column:
    """The bucket of a key; the same for every run with the same number of buckets."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched(df: DataFrame, column: str) -> list:
    """The distinct values of a column of few values (buckets, days), without null. They reach the driver."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def index_rows(events: DataFrame, batch: str, buckets: int = BUCKETS) -> DataFrame:
    """(event_id, record_date, bucket, batch) of events, one row an id."""
    return events.select("event_id", "record_date", key_bucket("event_id", buckets).alias("bucket"), F.lit(batch).alias("batch"))


def read_keys(spark: SparkSession, path: str, buckets: list[int], but: str | None = None) -> DataFrame:
    """Index rows of some buckets, without those that batch ``but`` wrote. A missing table has none."""
    from turnstile.sources import read_if_there

    rows = read_if_there(spark, path, KEY_INDEX).filter(F.col("bucket").isin(buckets))
    return rows if but is None else rows.filter(F.col("batch") != but)


def newest(index: DataFrame) -> DataFrame:
    """Of each id the row of the last batch: where its kept copy is stored now."""
    w = Window.partitionBy("bucket", "event_id").orderBy(F.col("batch").desc())
    return index.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def unseen(events: DataFrame, index: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Events whose id the index does not hold, whatever day they are stamped with."""
    known = index.select("bucket", "event_id")
    return events.withColumn("bucket", key_bucket("event_id", buckets)).join(known, ["bucket", "event_id"], "left_anti").select(*events.columns)
