from pyspark.sql import functions as F

from turnstile.functions import clock_label, minutes_between, period_rank, time_period


def test_time_period_bounds(spark):
    df = spark.range(0, 24).select(F.col("id").cast("int").alias("h"))
    got = {r.h: r.p for r in df.select("h", time_period(F.col("h")).alias("p")).collect()}
    assert [got[h] for h in (5, 6, 11, 12, 16, 17, 20, 21, 0, 23)] == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night", "Night",
    ]


def test_null_hour_is_night(spark):
    df = spark.createDataFrame([(None,)], "h int")
    assert df.select(time_period(F.col("h")).alias("p")).first().p == "Night"


def test_period_rank(spark):
    df = spark.createDataFrame([("Morning",), ("Afternoon",), ("Evening",), ("Night",)], "p string")
    assert [r.r for r in df.select(period_rank(F.col("p")).alias("r")).collect()] == [1, 2, 3, 4]


def test_clock_labels(spark):
    df = spark.createDataFrame([(h,) for h in (0, 1, 11, 12, 13, 23)], "h int")
    got = [r.t for r in df.select(clock_label(F.col("h")).alias("t")).collect()]
    assert got == ["12:00 AM", "1:00 AM", "11:00 AM", "12:00 PM", "1:00 PM", "11:00 PM"]


def test_minutes_floor_seconds_and_round(spark):
    df = spark.createDataFrame(
        [("2026-03-05 10:00:00.900", "2026-03-05 10:00:59.100"), ("2026-03-05 10:00:00", "2026-03-05 10:01:10")],
        "a string, b string",
    ).select(F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
    got = [r.m for r in df.select(minutes_between("a", "b").alias("m")).collect()]
    assert got == [0.98, 1.17]
