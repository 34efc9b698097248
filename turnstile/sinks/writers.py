"""Idempotent table writers.

Every write goes through Spark's file commit protocol: a lost executor retries its task and
only committed task output becomes visible, so a re-run of a job leaves the same table.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from turnstile.sources import partitions


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    max_records_per_file: int | None = 5_000_000,
    cluster_by: tuple[str, ...] = (),
) -> None:
    """Write Parquet. ``dynamic=True`` replaces only the partitions present in ``df``
    (a re-run of one day replaces that day); otherwise an overwrite replaces the table.

    ``cluster_by`` range-partitions and sorts the rows first (sampled bounds): every task
    then covers a contiguous slice of the partition directories, so the table gets about
    one file per task instead of one per task and directory, and a busy day is still split
    over many tasks. Sorted files also give tight min/max statistics for pushed filters.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def _directory(column: str, value) -> str:
    """The directory of a partition value, in the spelling of Spark's writer."""
    if value is None:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return column + "=" + re.sub(r"""[\x00-\x1f\x7f"#%'*/:=?\\{}\[\]^]""", lambda m: f"%{ord(m[0]):02X}", str(value))


def replace_days(df: DataFrame, path: str, days: list[dt.date], partition_by: tuple[str, ...] = ("record_date",), **options) -> None:
    """Make ``days`` (values of the first partition column) of a table hold exactly the rows of ``df``, which has no
    others.

    A dynamic overwrite swaps in the partitions that have rows when the job commits, and leaves the others as they are; a
    partition of these days that got none is then overwritten by name with an empty table. Which got rows is observed
    while they are written; which there are comes from the directories.
    """
    if not days:
        return
    spark, column = df.sparkSession, partition_by[0]
    got = Observation()
    listed = df.filter(F.col(column).isin(days)).observe(got, F.collect_set(F.struct(*partition_by)).alias("got"))
    write_table(listed, path, partition_by=partition_by, dynamic=True, **options)
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in partition_by)
    stale = set(partitions(spark, path, kinds, days)) - {tuple(p) for p in got.get.get("got") or ()}
    empty = spark.createDataFrame([], df.drop(*partition_by).schema)
    for values in stale:
        folder = "/".join(_directory(c, v) for c, v in zip(partition_by, values, strict=True))
        write_table(empty, f"{path}/{folder}")


def write_report(df: DataFrame, path: str, days: list[dt.date] | None = None) -> None:
    """A report table partitioned by ``record_date``.

    The whole-history job replaces the table (stale days go); with ``days`` exactly these days are replaced, those
    without rows too, so running a day again leaves what its data says now. Rows are dealt by date with
    a rebalance, which splits a busy day over several tasks and joins small ones, and each
    task sorts its rows; a global order would cost a sampling pass over the whole report.
    """
    order = [c for c in ("record_date", "room_id", "location", "record_hour", "entry_time", "student_id") if c in df.columns]
    dealt = df.hint("rebalance", "record_date").sortWithinPartitions(*order)
    if days is None:
        write_table(dealt, path, partition_by=("record_date",))
    else:
        replace_days(dealt, path, days)


def preview(df: DataFrame, name: str, rows: int = 20) -> None:
    """Print the first rows untruncated (runs the plan once more; off unless asked)."""
    print(f"--- {name} ---")
    df.show(rows, truncate=False)


def write_kafka(records: DataFrame, bootstrap_servers: str) -> None:
    """Batch-publish ``(topic, value)`` records (see ``route_events``). Needs the Kafka
    connector on the classpath, which is a deployment choice."""
    (
        records.select("topic", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .save()
    )
