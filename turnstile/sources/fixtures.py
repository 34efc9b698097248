"""Test-data views: gate events and students derived from the given ``events`` and
``customer`` tables (see FIXTURES.md section 4). The same derivations are written as SQL
in ``turnstile.plans.oracle`` so DuckDB can check every registered query.

Every view is a projection of a whole table: its size grows with the data.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Column types of the given tables (an explicit schema spares the footer-inference pass).
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _half(event_id: Column) -> Column:
    return F.shiftright(event_id, 1)  # ids are BIGINT and not negative


def _room_of(event_id: Column) -> Column:
    """One of twelve rooms, room00 to room11."""
    return F.concat(F.lit("room"), F.lpad((_half(event_id) % 12).cast("string"), 2, "0"))


def gate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain view: even ids pass the main gate, odd ids one of 12 rooms."""
    ev = _table(spark, sf_dir, "events")
    main = ev.event_id % 2 == 0
    return ev.select(
        ev.event_id.cast("string").alias("event_id"),
        ev.user_id.cast("string").alias("student_id"),
        F.when(ev.event_type.isin("click", "view", "signup"), F.lit("ENTRY"))
        .otherwise(F.lit("EXIT"))
        .alias("event_type"),
        F.when(main, F.lit("MAIN_GATE")).otherwise(F.lit("ROOM_GATE")).alias("gate_type"),
        F.when(main, F.lit("MAIN_HALL")).otherwise(_room_of(ev.event_id)).alias("location"),
        ev.ts.alias("timestamp"),
    )


def gate_events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain view with null students and late duplicate copies (one minute later)."""
    plain = gate_events(spark, sf_dir)
    n = plain.event_id.cast("long")
    nulled = plain.select(
        "event_id",
        F.when(n % 23 == 0, F.lit(None).cast("string")).otherwise(plain.student_id).alias("student_id"),
        "event_type", "gate_type", "location", "timestamp",
    )
    copies = plain.filter(n % 17 == 0).select(
        "event_id", "student_id", "event_type", "gate_type", "location",
        (F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))).alias("timestamp"),
    )
    return nulled.union(copies)


def gate_events_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty view in two batches (``arrival`` 0 or 1): an event and its late copy never come in the same one, and of every
    second pair the copy comes first."""
    plain = gate_events(spark, sf_dir)
    n = plain.event_id.cast("long")
    nulled = plain.select(
        "event_id",
        F.when(n % 23 == 0, F.lit(None).cast("string")).otherwise(plain.student_id).alias("student_id"),
        "event_type", "gate_type", "location", "timestamp", (n % 2).cast("int").alias("arrival"),
    )
    copies = plain.filter(n % 17 == 0).select(
        "event_id", "student_id", "event_type", "gate_type", "location",
        (F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))).alias("timestamp"),
        ((n + 1) % 2).cast("int").alias("arrival"),
    )
    return nulled.union(copies)


def gate_events_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five people and two rooms: many stays per person, room and day."""
    plain = gate_events(spark, sf_dir)
    half = _half(plain.event_id.cast("long"))
    return plain.select(
        "event_id",
        (plain.student_id.cast("long") % 5).cast("string").alias("student_id"),
        "event_type",
        "gate_type",
        F.when(plain.gate_type == "MAIN_GATE", plain.location)
        .when(half % 2 == 0, F.lit("room00"))
        .otherwise(F.lit("room01"))
        .alias("location"),
        "timestamp",
    )


def gate_events_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain view where one student ("0") holds a third of all events (every id divisible
    by 3), all of that student's room events in room00: the skewed-key case."""
    plain = gate_events(spark, sf_dir)
    hot = plain.event_id.cast("long") % 3 == 0
    return plain.select(
        "event_id",
        F.when(hot, F.lit("0")).otherwise(plain.student_id).alias("student_id"),
        "event_type",
        "gate_type",
        F.when(hot & (plain.gate_type == "ROOM_GATE"), F.lit("room00")).otherwise(plain.location).alias("location"),
        "timestamp",
    )


def gate_events_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain view with room events in the main hall (every 19th id) and null timestamps (every
    47th): what the questions must leave out."""
    plain = gate_events(spark, sf_dir)
    n = plain.event_id.cast("long")
    return plain.select(
        "event_id", "student_id", "event_type", "gate_type",
        F.when((plain.gate_type == "ROOM_GATE") & (n % 19 == 0), F.lit("MAIN_HALL")).otherwise(plain.location).alias("location"),
        F.when(n % 47 == 0, F.lit(None)).otherwise(plain.timestamp).alias("timestamp"),
    )


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Student dimension as text columns (like the CSV), every customer: ids that end in 03, 23 ... have no
    major, those that end in 13, 33 ... a year that is no number; years are written "2" or "2.0"."""
    cu = _table(spark, sf_dir, "customer")
    year = (cu.c_nationkey % 4 + 1).cast("string")
    return cu.select(
        cu.c_custkey.cast("string").alias("student_id"),
        F.when(cu.c_custkey % 20 == 3, F.lit(None)).otherwise(cu.c_mktsegment).alias("major"),
        F.when(cu.c_custkey % 20 == 13, F.lit("n/a")).when(cu.c_custkey % 7 == 0, F.concat(year, F.lit(".0"))).otherwise(year)
        .alias("year_of_study"),
        F.when(cu.c_acctbal >= 3000, F.lit("Undergraduate"))
        .otherwise(F.lit("Postgraduate"))
        .alias("study_level"),
    )
