"""The fixture views make every filter of the questions bite, and run on ids beyond INT."""

import duckdb
from pyspark.sql import functions as F

from turnstile.operators import analytics as A
from turnstile.operators import graph as G
from turnstile.plans import catalog
from turnstile.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_each_filter_changes_the_result(spark):
    odd = fx.gate_events_odd(spark, SF)
    students = G.students_dim(fx.students(spark, SF))
    # A main hall that passes for a room, timestamps that are there, students that are known:
    as_rooms = odd.withColumn("location", F.when(F.col("location") == "MAIN_HALL", F.lit("hall")).otherwise(F.col("location")))
    timed = odd.withColumn("timestamp", F.coalesce("timestamp", F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")))
    known = students.fillna("x", ["major"]).fillna(9, ["year_of_study"])
    rows = lambda df: sorted(map(str, df.collect()))
    period = lambda e, s: A.visits_by_period_major_year(e, s, as_of="2024-01-31 00:00:00", trailing_days=7)
    assert rows(A.room_popularity_by_group(G.e_entered(odd), students)) != rows(A.room_popularity_by_group(G.e_entered(as_rooms), students))
    assert rows(A.popular_rooms(odd, top=100)) != rows(A.popular_rooms(as_rooms, top=100))
    assert rows(period(odd, students)) != rows(period(timed, students))
    assert rows(period(odd, students)) != rows(period(odd, known))
    assert students.filter("major is null").count() and students.filter("year_of_study is null").count()
    assert students.count() == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_queries_run_on_ids_above_32_bits(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE events AS SELECT * REPLACE (event_id + 5000000001 AS event_id) FROM '{SF}/events.parquet'")
    con.execute(f"CREATE TABLE customer AS SELECT * FROM '{SF}/customer.parquet'")
    for t in ("events", "customer"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    for name in ("clean_events_full", "room_durations_full_dense", "room_durations_hot_range", "popular_rooms_odd"):
        got = catalog.queries()[name](spark, str(tmp_path)).count()
        assert got == con.execute(f"SELECT count(*) FROM ({catalog.oracle_sql()[name]})").fetchone()[0] > 0, name


def test_static_settings_are_passed_over(spark):
    from turnstile.session import build_session

    again = build_session(extra_conf={"spark.sql.warehouse.dir": "/elsewhere", "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")})
    assert again.conf.get("spark.sql.session.timeZone") == "UTC"
