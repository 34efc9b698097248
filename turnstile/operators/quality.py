"""Event loading helpers and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import record_date, ts_cutoff

# Full order used to pick one copy of a duplicated event id: earliest copy first, and
# every remaining column as a tie-break, so the choice is the same on every run.
COPY_ORDER = ("timestamp", "student_id", "event_type", "gate_type", "location")


def with_record_date(df: DataFrame) -> DataFrame:
    if "record_date" in df.columns:
        return df
    return df.withColumn("record_date", record_date("timestamp"))


def latest_day(df: DataFrame) -> DataFrame:
    """Rows of the latest ``record_date`` present (empty input -> empty output).

    The latest date is a scalar subquery: one plan, which reads the dates once more. A job
    that needs the day several times finds it once (``latest_date``) and filters by value.
    """
    dated = with_record_date(df)
    latest = dated.select(F.max("record_date")).scalar()
    return dated.filter(F.col("record_date") == latest)


def latest_date(df: DataFrame):
    """The latest ``record_date`` as a value, None for no rows. One date reaches the driver; a
    filter by it prunes a date-partitioned table when the plan is made."""
    return with_record_date(df).agg(F.max("record_date")).first()[0]


def dedupe_events(df: DataFrame, add_record_date: bool = False) -> DataFrame:
    """One row per ``event_id``: the first copy by time, then by the other columns.

    ``row_number() == 1`` is planned as a WindowGroupLimit: each map task already keeps one
    copy per id before the shuffle, so a heavily repeated id does not pile up in one task.
    ``add_record_date`` adds the date column in the same projection.
    """
    cols = df.columns
    if add_record_date and "record_date" not in cols:
        extra = [record_date("timestamp").alias("record_date")]
        out = [*cols, "record_date"]
    else:
        extra, out = [], cols
    order = [F.col(c).asc_nulls_last() for c in COPY_ORDER if c in cols]
    w = Window.partitionBy("event_id").orderBy(*order)
    ranked = df.select("*", *extra, F.row_number().over(w).alias("_copy"))
    return ranked.filter(F.col("_copy") == 1).select(*out)


def valid_events(df: DataFrame, as_of=None, check_time: bool = True) -> DataFrame:
    """Student present, (optionally) not in the future. ``as_of=None``: the current time."""
    cond = F.col("student_id").isNotNull()
    if check_time:
        cond = cond & (F.col("timestamp") <= ts_cutoff(df, "timestamp", as_of))
    return df.filter(cond)


def clean_events(df: DataFrame, as_of=None, check_time: bool = True) -> DataFrame:
    """Quality checks: valid events, one row per id.

    The validity filters run before the dedupe so they reach the Parquet scan and a bad copy
    can never hide a good one.
    """
    return dedupe_events(valid_events(df, as_of, check_time), add_record_date=True)


def clean_events_full(df: DataFrame, as_of=None) -> DataFrame:
    """Whole-history checks (student present, timestamp not after ``as_of``)."""
    return clean_events(df, as_of=as_of, check_time=True)


def clean_events_daily(df: DataFrame, latest: bool = False) -> DataFrame:
    """Latest-day checks: the latest date is taken over all rows, then student present.
    ``latest=True``: ``df`` holds that day's rows already."""
    return clean_events(df if latest else latest_day(df), check_time=False)
