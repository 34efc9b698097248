"""Closed days of the curated table in few files.

The stream's sink keeps a log of its files and shows no others, so its table cannot be rewritten in place. Closed days are copied
into a table of their own, with a note of the files that each copy was made from. A reader takes a day from the copy if
the curated table still has just these files for it, else from the curated table: a row that lands late is never missed,
and the next compaction copies that day again. The stream goes on meanwhile.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.config import Settings
from turnstile.schema import CLEAN_EVENT
from turnstile.sinks import replace_days, write_table
from turnstile.sources import read_curated, read_if_there

LOG = "record_date DATE, files STRING"
PARTITIONS = ("record_date", "gate_type")


def day_files(table: DataFrame) -> dict[dt.date, str]:
    """A digest of the names of each day's files, from the listing that every scan makes; no file is opened."""
    names: dict[dt.date, list[str]] = defaultdict(list)
    for path in table.inputFiles():
        day = unquote(path).split("record_date=", 1)[1].split("/", 1)[0]
        if day[0].isdigit():
            names[dt.date.fromisoformat(day)].append(path.rsplit("/", 1)[1])
    return {day: hashlib.sha256("\n".join(sorted(some)).encode()).hexdigest() for day, some in names.items()}


def _noted(spark: SparkSession, settings: Settings) -> dict[dt.date, str]:
    """The digests of the copied days: one row a day."""
    return dict(map(tuple, read_if_there(spark, f"{settings.compacted}_files", LOG).select("record_date", "files").collect()))


def compact(spark: SparkSession, settings: Settings, before: dt.date, rows_a_file: int = 5_000_000) -> list[dt.date]:
    """Copy the days before ``before`` that have changed since they were copied; the days copied. The rows of a day are
    dealt by a rebalance into files of the session's advisory size, ``rows_a_file`` at most."""
    curated = read_curated(spark, settings.curated)
    noted, present = _noted(spark, settings), day_files(curated)
    days = sorted(d for d, files in present.items() if d < before and noted.get(d) != files)
    if days:
        some = curated.filter(F.col("record_date").isin(days)).hint("rebalance", *PARTITIONS)
        replace_days(some, settings.compacted, days, partition_by=PARTITIONS, max_records_per_file=rows_a_file)
        # A day's note goes last: until then the reader takes it from the curated table. The digest was taken before the copy,
        # so files that came meanwhile make it stale.
        notes = spark.createDataFrame([(d, present[d]) for d in days], LOG)
        write_table(notes, f"{settings.compacted}_files", partition_by=("record_date",), dynamic=True)
    return days


def read_events(spark: SparkSession, settings: Settings) -> DataFrame:
    """The curated events: closed days from their copies, all others (and events without a day) from the curated table."""
    curated = read_curated(spark, settings.curated)
    present = day_files(curated)
    days = [d for d, files in _noted(spark, settings).items() if present.get(d) == files]
    if not days:
        return curated
    copies = read_if_there(spark, settings.compacted, CLEAN_EVENT).filter(F.col("record_date").isin(days))
    fresh = curated.filter(~F.coalesce(F.col("record_date").isin(days), F.lit(False)))
    return fresh.unionByName(copies.select(*[F.col(f.name).cast(f.dataType) for f in curated.schema]))
