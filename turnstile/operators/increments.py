"""Increments of the clean table: what rows that arrive later change in the whole-history result.

The kept copy of an id is the first by (time, other columns) of all its valid copies. A new copy changes the table only if its id
is new or if it comes before the kept one; then the day of the new copy and the day of the old one are touched. Only touched
days are written again. In whatever order copies arrive, the result is that of one run over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import ts_cutoff
from turnstile.operators.quality import COPY_ORDER, dedupe_events, valid_events, with_record_date


def due(rows: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(rows that count now, rows that are stamped later than ``as_of`` and have to wait). Rows without a student or a
    time never count."""
    dated = valid_events(with_record_date(rows), check_time=False)
    cutoff = ts_cutoff(dated, "timestamp", as_of)
    return dated.filter(F.col("timestamp") <= cutoff), dated.filter(F.col("timestamp") > cutoff)


def located(increment: DataFrame, index: DataFrame) -> DataFrame:
    """One copy of each id of the increment, with ``old_date``: the day of its kept copy so far, null for a new id."""
    known = index.select("event_id", F.col("record_date").alias("old_date"))
    return dedupe_events(increment).join(known, "event_id", "left").select(*increment.columns, "old_date")


def changed_copies(increment: DataFrame, stored: DataFrame) -> DataFrame:
    """The copies of a ``located`` increment that become their id's kept copy. ``stored`` has the kept copies of its ids."""
    old = stored.join(increment.select("event_id"), "event_id", "left_semi")
    both = increment.withColumn("_stored", F.lit(0)).unionByName(old.withColumn("_stored", F.lit(1)), allowMissingColumns=True)
    order = [F.col(c).asc_nulls_last() for c in COPY_ORDER] + [F.col("_stored").desc()]
    first = F.row_number().over(Window.partitionBy("event_id").orderBy(*order))
    best = both.withColumn("_copy", first).filter((F.col("_copy") == 1) & (F.col("_stored") == 0))
    return best.select(*increment.columns)


def redone(clean: DataFrame, changed: DataFrame) -> DataFrame:
    """The clean rows (of the touched days, or of all) after the change; applied twice it is the same."""
    ids = changed.select("event_id")
    return clean.join(ids, "event_id", "left_anti").select(*clean.columns).unionByName(changed.select(*clean.columns))
