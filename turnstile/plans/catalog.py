"""Registered queries: one Spark builder ``(spark, sf_dir) -> DataFrame`` per key, and the
DuckDB SQL that must give the same rows (``turnstile.plans.oracle``).

Inputs are the fixture views over the whole given tables (FIXTURES.md section 4): the
plain view for the graph and analytics, the dirty view for the quality checks and the
reports, the dense view where stays repeat (latest-day stays, last-stay-wins edges, a second
Q1/Q2 run), and the hot view where one student holds a third of all events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.operators import analytics as A
from turnstile.operators import graph as G
from turnstile.operators import reports as R
from turnstile.operators.carry import closed_stays, open_entries
from turnstile.operators.increments import changed_copies, due, located, redone
from turnstile.operators.ingest import JSON_WRITE_OPTIONS, parse_events, rejected_payloads, route_events, to_json_value
from turnstile.operators.keys import index_rows, unseen
from turnstile.operators.quality import (
    clean_events_daily,
    clean_events_full,
    dedupe_events,
    latest_day,
    valid_events,
    with_record_date,
)
from turnstile.operators.visitors import (
    daily_visits_from_daily,
    number_students,
    visit_summary_from_daily,
    visits_by_period_from_daily,
    visits_daily,
)
from turnstile.plans.oracle import (
    AS_OF_CLEAN,
    AS_OF_GRAPH,
    COPY_ORDER_SQL,
    Q2_CUTOFF,
    TRAILING_DAYS,
    clean_daily_cte,
    clean_full_cte,
    durations_cte,
    latest_cte,
    period_sql,
    with_views,
)
from turnstile.schema import EVENT_COLUMNS, GATE_EVENT_NTZ
from turnstile.session import scratch_folder
from turnstile.sinks import write_table
from turnstile.sources import fixtures as fx
from turnstile.sources import read_curated

Builder = Callable[[SparkSession, str], DataFrame]


# -- inputs -------------------------------------------------------------------------------

def _clean_dirty_full(spark, sf):
    return clean_events_full(fx.gate_events_dirty(spark, sf), as_of=AS_OF_CLEAN)


def _clean_dirty_daily(spark, sf):
    return clean_events_daily(fx.gate_events_dirty(spark, sf))


def _clean_dense_daily(spark, sf):
    return clean_events_daily(fx.gate_events_dense(spark, sf))


def _clean_plain(spark, sf):
    return clean_events_full(fx.gate_events(spark, sf), as_of=AS_OF_GRAPH)


def _clean_dense(spark, sf):
    return clean_events_full(fx.gate_events_dense(spark, sf), as_of=AS_OF_GRAPH)


def _clean_hot(spark, sf):
    return clean_events_full(fx.gate_events_hot(spark, sf), as_of=AS_OF_GRAPH)


def _students(spark, sf):
    return G.students_dim(fx.students(spark, sf))


CTE_DIRTY_FULL = [("clean", clean_full_cte("gate_events_dirty", AS_OF_CLEAN))]
CTE_DIRTY_DAILY = [("latest", latest_cte("gate_events_dirty")), ("clean", clean_daily_cte("latest"))]
CTE_DENSE_DAILY = [("latest", latest_cte("gate_events_dense")), ("clean", clean_daily_cte("latest"))]
CTE_PLAIN = [("clean", clean_full_cte("gate_events", AS_OF_GRAPH))]
CTE_DENSE = [("clean", clean_full_cte("gate_events_dense", AS_OF_GRAPH))]
CTE_HOT = [("clean", clean_full_cte("gate_events_hot", AS_OF_GRAPH))]
KNOWN = (
    "known",
    " SELECT student_id, major, year_of_study AS year FROM students"
    " WHERE major IS NOT NULL AND year_of_study IS NOT NULL",
)


# -- ingest -------------------------------------------------------------------------------

def _payloads(spark, sf):
    """JSON payloads built from every gate event, with malformed ones mixed in: every 29th
    is not JSON, every 31st has a bad timestamp, every 37th sends the id as a number."""
    ev = fx.gate_events(spark, sf)
    n = F.col("event_id").cast("long")
    good = to_json_value(ev)
    bad_time = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS[:-1]], F.lit("soon").alias("timestamp")))
    numeric_id = F.to_json(F.struct(n.alias("event_id"), *[F.col(c) for c in EVENT_COLUMNS[1:]]), JSON_WRITE_OPTIONS)
    value = (
        F.when(n % 29 == 0, F.concat(F.lit("not json "), F.col("event_id")))
        .when(n % 31 == 0, bad_time)
        .when(n % 37 == 0, numeric_id)
        .otherwise(good)
    )
    return ev.select(value.cast("binary").alias("value"))


def q_parse_events(spark, sf):
    return parse_events(_payloads(spark, sf), schema=GATE_EVENT_NTZ)


SQL_PARSE_EVENTS = with_views([], """
SELECT event_id, student_id, event_type, gate_type, location,
       CASE WHEN CAST(event_id AS BIGINT) % 31 = 0 THEN NULL ELSE timestamp END AS timestamp
FROM gate_events WHERE CAST(event_id AS BIGINT) % 29 <> 0""")


def q_rejected_payloads(spark, sf):
    """The payloads above, with ones that have no id (every 53rd) and no payload at all (every 59th): which are
    rejected, and why."""
    ev = fx.gate_events(spark, sf)
    n = F.col("event_id").cast("long")
    value = (
        F.when(n % 29 == 0, F.concat(F.lit("not json "), F.col("event_id")))
        .when(n % 53 == 0, F.concat(F.lit('{"student_id": "'), F.col("student_id"), F.lit('"}')))
        .when(n % 59 != 0, to_json_value(ev))
    )
    return rejected_payloads(ev.select(value.cast("binary").alias("value")), schema=GATE_EVENT_NTZ)


SQL_REJECTED_PAYLOADS = with_views([], """
SELECT CASE WHEN n % 29 = 0 THEN 'not json ' || event_id
            WHEN n % 53 = 0 THEN '{"student_id": "' || student_id || '"}' END AS value,
       CASE WHEN n % 29 = 0 THEN 'not a JSON object' WHEN n % 53 = 0 THEN 'no event_id' ELSE 'no payload' END AS reason
FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM gate_events) WHERE n % 29 = 0 OR n % 53 = 0 OR n % 59 = 0""")


def q_route_events(spark, sf):
    """Route every event (some with an unknown or missing gate type), then read the JSON
    value back: topic plus the event fields."""
    ev = fx.gate_events(spark, sf)
    n = F.col("event_id").cast("long")
    ev = ev.withColumn(
        "gate_type",
        F.when(n % 41 == 0, F.lit("SERVICE_GATE")).when(n % 43 == 0, F.lit(None)).otherwise(F.col("gate_type")),
    )
    routed = route_events(ev)
    return routed.select("topic", F.from_json("value", GATE_EVENT_NTZ).alias("e")).select("topic", "e.*")


SQL_ROUTE_EVENTS = with_views([], """
SELECT CASE gate_type WHEN 'MAIN_GATE' THEN 'main_gate_events' ELSE 'room_gate_events' END AS topic,
       event_id, student_id, event_type, gate_type, location, timestamp
FROM gate_events WHERE CAST(event_id AS BIGINT) % 41 <> 0 AND CAST(event_id AS BIGINT) % 43 <> 0""")


def q_curated_events(spark, sf):
    return with_record_date(fx.gate_events(spark, sf))


SQL_CURATED_EVENTS = with_views([], "SELECT *, CAST(timestamp AS DATE) AS record_date FROM gate_events")


def q_latest_day_events(spark, sf):
    return latest_day(fx.gate_events_dirty(spark, sf))


SQL_LATEST_DAY_EVENTS = with_views([("latest", latest_cte("gate_events_dirty"))], "SELECT * FROM latest")


# -- quality --------------------------------------------------------------------------------

SQL_CLEAN_FULL = with_views(CTE_DIRTY_FULL, "SELECT * FROM clean")
SQL_CLEAN_DAILY = with_views(CTE_DIRTY_DAILY, "SELECT * FROM clean")

# -- reports --------------------------------------------------------------------------------

_HOURLY_GATE_FULL = """
SELECT record_date, CAST(hour(timestamp) AS INTEGER) AS record_hour,
       CAST(sum(CASE WHEN event_type = 'ENTRY' THEN 1 ELSE 0 END) AS BIGINT) AS total_hourly_entries,
       CAST(sum(CASE WHEN event_type = 'EXIT' THEN 1 ELSE 0 END) AS BIGINT) AS total_hourly_exits
FROM clean WHERE gate_type = 'MAIN_GATE' GROUP BY 1, 2 ORDER BY 1, 2"""
_HOURLY_GATE_DAILY = """
SELECT record_date, CAST(hour(timestamp) AS INTEGER) AS record_hour, count(event_id) AS total_hourly_entries
FROM clean WHERE gate_type = 'MAIN_GATE' AND event_type = 'ENTRY' GROUP BY 1, 2 ORDER BY 1, 2"""
_DAILY_ROOM = """
SELECT record_date, location, count(event_id) AS total_room_entries
FROM clean WHERE gate_type = 'ROOM_GATE' AND event_type = 'ENTRY'
GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2"""
_HOURLY_ROOM_FULL = """
SELECT record_date, location AS room_id, CAST(hour(timestamp) AS INTEGER) AS record_hour,
       CAST(sum(CASE WHEN event_type = 'ENTRY' THEN 1 ELSE 0 END) AS BIGINT) AS total_entries,
       CAST(sum(CASE WHEN event_type = 'EXIT' THEN 1 ELSE 0 END) AS BIGINT) AS total_exits
FROM clean WHERE gate_type = 'ROOM_GATE' GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""
_HOURLY_ROOM_DAILY = """
SELECT record_date, location AS room_id, CAST(hour(timestamp) AS INTEGER) AS entry_hour,
       count(student_id) AS total_visits
FROM clean WHERE gate_type = 'ROOM_GATE' AND event_type = 'ENTRY' GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""
_DURATIONS = "SELECT * FROM durations ORDER BY record_date, room_id, entry_time, student_id"


def _durations_sql(base):
    return with_views(base + [("durations", durations_cte("clean"))], _DURATIONS)


# -- increments -----------------------------------------------------------------------------

def q_merge_events(spark, sf):
    """Two micro-batches merged by id: the copy that comes first stays, whatever its day."""
    arrivals = valid_events(fx.gate_events_arrivals(spark, sf), check_time=False)
    first, second = (with_record_date(dedupe_events(arrivals.filter(F.col("arrival") == i))) for i in (0, 1))
    return first.unionByName(unseen(second, index_rows(first, "1"))).drop("arrival")


SQL_MERGE_EVENTS = with_views([], f"""
SELECT event_id, student_id, event_type, gate_type, location, timestamp, CAST(timestamp AS DATE) AS record_date FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival, {COPY_ORDER_SQL}) AS _copy
  FROM gate_events_arrivals WHERE student_id IS NOT NULL) WHERE _copy = 1""")


def q_clean_events_increments(spark, sf):
    """History, then an increment with late copies and with originals of copies that came before: as one run over both."""
    now, _ = due(fx.gate_events_arrivals(spark, sf), AS_OF_CLEAN)
    history, later = (now.filter(F.col("arrival") == i).drop("arrival") for i in (0, 1))
    clean = dedupe_events(history)
    changed = changed_copies(located(later, index_rows(clean, "1")), clean)
    return redone(clean, changed)


DAY_CUTS = ("2024-01-01", "2024-01-11", "2024-01-12", "2024-01-21", "2024-02-01")


def q_room_durations_increments(spark, sf):
    """Ranges of days paired one after the other, each with the entries still open before it."""
    clean, before, parts = _clean_dense(spark, sf), None, []
    for first, last in zip(DAY_CUTS, DAY_CUTS[1:]):
        days = clean.filter((F.col("record_date") >= F.lit(first).cast("date")) & (F.col("record_date") < F.lit(last).cast("date")))
        parts.append(closed_stays(days, before).drop("closed_date"))
        before = open_entries(days, before, [dt.date.fromisoformat(last) - dt.timedelta(days=1)])
    return reduce(DataFrame.unionByName, parts)


def _visits_daily(spark, sf):
    clean, students = _clean_plain(spark, sf), _students(spark, sf)
    return visits_daily(clean, students, number_students(clean))


def q_curated_table(spark, sf):
    """The curated events written by gate, as the original's stream does, and read back through ``read_curated``."""
    path = scratch_folder(spark)
    write_table(fx.gate_events(spark, sf), path, partition_by=("gate_type",))
    return with_record_date(read_curated(spark, path))


# -- graph ----------------------------------------------------------------------------------

_V_STUDENT = """
SELECT student_id, major, year_of_study
FROM students FULL OUTER JOIN (SELECT DISTINCT student_id FROM clean WHERE student_id IS NOT NULL) seen
USING (student_id)"""
_E_STUDIED_IN = """
SELECT student_id, location, date, duration_minutes, entry_time, exit_time FROM (
  SELECT student_id, room_id AS location, record_date AS date, occupied_minutes AS duration_minutes,
         entry_time, exit_time,
         row_number() OVER (PARTITION BY student_id, room_id, record_date
                            ORDER BY entry_time DESC, exit_time DESC, occupied_minutes DESC) AS _rk
  FROM durations) WHERE _rk = 1"""

# -- analytics ------------------------------------------------------------------------------

_Q1 = """
SELECT major, year, {cells} FROM (
  SELECT *, row_number() OVER (PARTITION BY major, year ORDER BY visits DESC, room ASC NULLS LAST) AS rk
  FROM (SELECT major, year, location AS room, count(*) AS visits
        FROM (SELECT DISTINCT student_id, location FROM clean WHERE gate_type = 'ROOM_GATE') entered
        JOIN known USING (student_id)
        WHERE location <> 'MAIN_HALL' GROUP BY 1, 2, 3))
WHERE rk <= 5 GROUP BY major, year ORDER BY major, year""".format(
    cells=", ".join(
        f"max(CASE WHEN rk = {i} THEN room END) AS top_room_{i}, max(CASE WHEN rk = {i} THEN visits END) AS visits_{i}"
        for i in range(1, 6)
    )
)
_Q1_VISITS = _Q1.replace(
    "(SELECT DISTINCT student_id, location FROM clean WHERE gate_type = 'ROOM_GATE')",
    "(SELECT student_id, location FROM clean WHERE gate_type = 'ROOM_GATE' AND event_type = 'ENTRY')",
)
# The odd view is read as it is: the cleaning would take its null timestamps away.
CTE_ODD = [("clean", " SELECT * FROM gate_events_odd")]
_PER_STUDENT = (
    "per_student",
    f""" SELECT CAST(timestamp AS DATE) AS visit_date, {period_sql('timestamp')} AS time_period,
         student_id, count(*) AS n
  FROM clean WHERE gate_type = 'MAIN_GATE' AND event_type = 'ENTRY' AND timestamp IS NOT NULL
    AND timestamp >= TIMESTAMP '{Q2_CUTOFF}'
  GROUP BY 1, 2, 3""",
)
_Q2 = """
SELECT t.visit_date, t.time_period, t.visits, t.unique_students,
       top.major AS most_visited_major, top.year AS most_visited_major_study_year
FROM (SELECT visit_date, time_period, CAST(sum(n) AS BIGINT) AS visits, count(student_id) AS unique_students
      FROM per_student GROUP BY 1, 2) t
JOIN (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY visit_date, time_period
                                     ORDER BY mt DESC, major ASC NULLS LAST, my DESC, year ASC NULLS LAST) AS rk
        FROM (SELECT *, sum(my) OVER (PARTITION BY visit_date, time_period, major) AS mt
              FROM (SELECT visit_date, time_period, major, year, sum(n) AS my
                    FROM per_student LEFT JOIN known USING (student_id) GROUP BY 1, 2, 3, 4)))
      WHERE rk = 1) top
USING (visit_date, time_period)
ORDER BY t.visit_date DESC,
  CASE t.time_period WHEN 'Morning' THEN 1 WHEN 'Afternoon' THEN 2 WHEN 'Evening' THEN 3 WHEN 'Night' THEN 4 END"""
_Q2_GROUPS = """
SELECT visit_date, time_period, major, year, CAST(sum(n) AS BIGINT) AS visits, count(student_id) AS unique_students
FROM per_student LEFT JOIN known USING (student_id) GROUP BY 1, 2, 3, 4"""
_Q3 = """
SELECT total_entries, unique_students, unique_days,
       CAST(total_entries AS DOUBLE) / nullif(unique_students, 0) AS visits_per_student,
       CAST(total_entries AS DOUBLE) / nullif(unique_days, 0) AS visits_per_day,
       (CAST(total_entries AS DOUBLE) / nullif(unique_students, 0)) / nullif(unique_days, 0)
         AS visits_per_student_per_day
FROM (SELECT count(*) AS total_entries, count(DISTINCT student_id) AS unique_students,
             count(DISTINCT CAST(timestamp + INTERVAL 8 HOUR AS DATE)) AS unique_days
      FROM clean WHERE gate_type = 'MAIN_GATE' AND event_type = 'ENTRY')"""
# The clock labels of the original.
_Q4 = """
SELECT local_hour,
       CASE WHEN local_hour = 0 THEN '12:00 AM'
            WHEN local_hour < 12 THEN CAST(local_hour AS VARCHAR) || ':00 AM'
            WHEN local_hour = 12 THEN '12:00 PM'
            ELSE CAST(local_hour - 12 AS VARCHAR) || ':00 PM' END AS time,
       visits
FROM (SELECT CAST(hour(timestamp + INTERVAL 8 HOUR) AS INTEGER) AS local_hour, count(*) AS visits
      FROM clean WHERE gate_type = 'MAIN_GATE' AND event_type = 'ENTRY' GROUP BY 1)
ORDER BY visits DESC, local_hour ASC NULLS LAST LIMIT 5"""
_Q5 = """
SELECT location AS room, count(*) AS visits
FROM clean WHERE gate_type = 'ROOM_GATE' AND event_type = 'ENTRY' AND location <> 'MAIN_HALL'
GROUP BY 1 ORDER BY visits DESC, room ASC NULLS LAST LIMIT 5"""


def _q2_args():
    return dict(as_of=AS_OF_GRAPH, trailing_days=TRAILING_DAYS)


# -- the registry ---------------------------------------------------------------------------

REGISTRY: dict[str, tuple[Builder, str | None]] = {
    # ingest
    "parse_events": (q_parse_events, SQL_PARSE_EVENTS),
    "rejected_payloads": (q_rejected_payloads, SQL_REJECTED_PAYLOADS),
    "route_events": (q_route_events, SQL_ROUTE_EVENTS),
    "curated_events": (q_curated_events, SQL_CURATED_EVENTS),
    "latest_day_events": (q_latest_day_events, SQL_LATEST_DAY_EVENTS),
    # quality
    "clean_events_full": (_clean_dirty_full, SQL_CLEAN_FULL),
    "clean_events_daily": (_clean_dirty_daily, SQL_CLEAN_DAILY),
    # reports, whole history (dirty input cleaned as of a fixed time) and latest day
    "hourly_gate_traffic_full": (
        lambda s, sf: R.hourly_gate_traffic_full(_clean_dirty_full(s, sf)),
        with_views(CTE_DIRTY_FULL, _HOURLY_GATE_FULL),
    ),
    "hourly_gate_traffic_daily": (
        lambda s, sf: R.hourly_gate_traffic_daily(_clean_dirty_daily(s, sf)),
        with_views(CTE_DIRTY_DAILY, _HOURLY_GATE_DAILY),
    ),
    "daily_room_usage_full": (
        lambda s, sf: R.daily_room_usage_full(_clean_dirty_full(s, sf)),
        with_views(CTE_DIRTY_FULL, _DAILY_ROOM),
    ),
    "daily_room_usage_daily": (
        lambda s, sf: R.daily_room_usage_daily(_clean_dirty_daily(s, sf)),
        with_views(CTE_DIRTY_DAILY, _DAILY_ROOM),
    ),
    "hourly_room_usage_full": (
        lambda s, sf: R.hourly_room_usage_full(_clean_dirty_full(s, sf)),
        with_views(CTE_DIRTY_FULL, _HOURLY_ROOM_FULL),
    ),
    "hourly_room_usage_daily": (
        lambda s, sf: R.hourly_room_usage_daily(_clean_dirty_daily(s, sf)),
        with_views(CTE_DIRTY_DAILY, _HOURLY_ROOM_DAILY),
    ),
    "room_durations_full": (
        lambda s, sf: R.room_durations_full(_clean_dirty_full(s, sf)),
        _durations_sql(CTE_DIRTY_FULL),
    ),
    "room_durations_full_dense": (
        lambda s, sf: R.room_durations_full(_clean_dense(s, sf)),
        _durations_sql(CTE_DENSE),
    ),
    "room_durations_daily": (
        lambda s, sf: R.room_durations_daily(_clean_dense_daily(s, sf)),
        _durations_sql(CTE_DENSE_DAILY),
    ),
    # one student holding a third of all events: pairing and pre-aggregation
    "room_durations_hot_range": (
        lambda s, sf: R.room_durations_full(_clean_hot(s, sf)),
        _durations_sql(CTE_HOT),
    ),
    # increments: merge by id, redone days, stays across runs, mergeable distinct counts
    "merge_events": (q_merge_events, SQL_MERGE_EVENTS),
    "clean_events_increments": (q_clean_events_increments, SQL_CLEAN_FULL),
    "room_durations_increments": (q_room_durations_increments, _durations_sql(CTE_DENSE)),
    "curated_table": (q_curated_table, SQL_CURATED_EVENTS),
    # student dimension and graph tables
    "students_dim": (_students, with_views([], "SELECT student_id, major, year_of_study, study_level FROM students")),
    "v_student": (
        lambda s, sf: G.v_student(_students(s, sf), _clean_plain(s, sf)),
        with_views(CTE_PLAIN, _V_STUDENT),
    ),
    "v_event": (
        lambda s, sf: G.v_event(_clean_plain(s, sf)),
        with_views(CTE_PLAIN, "SELECT event_id, event_type, gate_type, location, timestamp FROM clean"),
    ),
    "v_library": (
        lambda s, sf: G.v_library(valid_events(fx.gate_events(s, sf), as_of=AS_OF_GRAPH)),
        with_views(CTE_PLAIN, "SELECT DISTINCT 'Main Library' AS name FROM clean"),
    ),
    "v_room": (
        lambda s, sf: G.v_room(_clean_plain(s, sf)),
        with_views(CTE_PLAIN, "SELECT DISTINCT location FROM clean WHERE gate_type = 'ROOM_GATE'"),
    ),
    "e_performed": (
        lambda s, sf: G.e_performed(_clean_plain(s, sf)),
        with_views(CTE_PLAIN, "SELECT student_id, event_id FROM clean"),
    ),
    "e_at_library": (
        lambda s, sf: G.e_at_library(_clean_plain(s, sf)),
        with_views(CTE_PLAIN, "SELECT event_id, 'Main Library' AS name FROM clean WHERE gate_type = 'MAIN_GATE'"),
    ),
    "e_in_room": (
        lambda s, sf: G.e_in_room(_clean_plain(s, sf)),
        with_views(CTE_PLAIN, "SELECT event_id, location FROM clean WHERE gate_type = 'ROOM_GATE'"),
    ),
    "e_entered": (
        lambda s, sf: G.e_entered(_clean_plain(s, sf)),
        with_views(CTE_PLAIN, "SELECT DISTINCT student_id, location FROM clean WHERE gate_type = 'ROOM_GATE'"),
    ),
    "e_studied_in": (
        lambda s, sf: G.e_studied_in(R.room_durations(_clean_dense(s, sf), ordered=False)),
        with_views(CTE_DENSE + [("durations", durations_cte("clean"))], _E_STUDIED_IN),
    ),
    # analytics
    "top5_rooms_by_major_year": (
        lambda s, sf: A.top_rooms_by_major_year(G.e_entered(_clean_plain(s, sf)), _students(s, sf)),
        with_views(CTE_PLAIN + [KNOWN], _Q1),
    ),
    "top5_rooms_by_major_year_dense": (
        lambda s, sf: A.top_rooms_by_major_year(G.e_entered(_clean_dense(s, sf)), _students(s, sf)),
        with_views(CTE_DENSE + [KNOWN], _Q1),
    ),
    "top5_rooms_by_major_year_visits": (
        lambda s, sf: A.top_rooms_by_major_year(_clean_plain(s, sf), _students(s, sf), count_mode="visits"),
        with_views(CTE_PLAIN + [KNOWN], _Q1_VISITS),
    ),
    # main-hall events at room gates and null timestamps, which the questions leave out
    "top5_rooms_by_major_year_odd": (
        lambda s, sf: A.top_rooms_by_major_year(G.e_entered(fx.gate_events_odd(s, sf)), _students(s, sf)),
        with_views(CTE_ODD + [KNOWN], _Q1),
    ),
    "popular_rooms_odd": (lambda s, sf: A.popular_rooms(fx.gate_events_odd(s, sf)), with_views(CTE_ODD, _Q5)),
    "daily_visits_by_period_odd": (
        lambda s, sf: A.daily_visits_by_period(fx.gate_events_odd(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_ODD + [KNOWN, _PER_STUDENT], _Q2),
    ),
    "daily_visits_by_period": (
        lambda s, sf: A.daily_visits_by_period(_clean_plain(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_PLAIN + [KNOWN, _PER_STUDENT], _Q2),
    ),
    "daily_visits_by_period_dense": (
        lambda s, sf: A.daily_visits_by_period(_clean_dense(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_DENSE + [KNOWN, _PER_STUDENT], _Q2),
    ),
    "top5_rooms_by_major_year_hot": (
        lambda s, sf: A.top_rooms_by_major_year(G.e_entered(_clean_hot(s, sf)), _students(s, sf)),
        with_views(CTE_HOT + [KNOWN], _Q1),
    ),
    "daily_visits_by_period_hot": (
        lambda s, sf: A.daily_visits_by_period(_clean_hot(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_HOT + [KNOWN, _PER_STUDENT], _Q2),
    ),
    "visits_by_period_major_year": (
        lambda s, sf: A.visits_by_period_major_year(_clean_plain(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_PLAIN + [KNOWN, _PER_STUDENT], _Q2_GROUPS),
    ),
    "visit_summary": (lambda s, sf: A.visit_summary(_clean_plain(s, sf)), with_views(CTE_PLAIN, _Q3)),
    "visits_by_period_bitmaps": (
        lambda s, sf: visits_by_period_from_daily(_visits_daily(s, sf), _clean_plain(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_PLAIN + [KNOWN, _PER_STUDENT], _Q2_GROUPS),
    ),
    "daily_visits_by_period_bitmaps": (
        lambda s, sf: daily_visits_from_daily(_visits_daily(s, sf), _clean_plain(s, sf), _students(s, sf), **_q2_args()),
        with_views(CTE_PLAIN + [KNOWN, _PER_STUDENT], _Q2),
    ),
    "visit_summary_bitmaps": (lambda s, sf: visit_summary_from_daily(_visits_daily(s, sf)), with_views(CTE_PLAIN, _Q3)),
    "peak_hours": (lambda s, sf: A.peak_hours(_clean_plain(s, sf)), with_views(CTE_PLAIN, _Q4)),
    "popular_rooms": (lambda s, sf: A.popular_rooms(_clean_plain(s, sf)), with_views(CTE_PLAIN, _Q5)),
}


def queries() -> dict[str, Builder]:
    return {name: build for name, (build, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
