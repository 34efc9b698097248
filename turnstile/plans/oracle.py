"""DuckDB SQL for the registered queries (the correctness oracle).

The fixture views of ``turnstile.sources.fixtures`` are repeated here as CTEs over the
pre-registered ``events`` and ``customer`` views, then each query is written in plain SQL
with the same full sort orders (``NULLS LAST`` spelled out: the engines differ by default).
DuckDB aggregate types are cast to the Spark ones (BIGINT sums, INTEGER hours).
"""

from __future__ import annotations

AS_OF_CLEAN = "2024-01-28 00:00:00"
AS_OF_GRAPH = "2024-01-31 00:00:00"
TRAILING_DAYS = 7
Q2_CUTOFF = "2024-01-24 00:00:00"  # AS_OF_GRAPH - TRAILING_DAYS

VIEWS = {
    "gate_events": """
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS student_id,
    CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'ENTRY' ELSE 'EXIT' END AS event_type,
    CASE WHEN event_id % 2 = 0 THEN 'MAIN_GATE' ELSE 'ROOM_GATE' END AS gate_type,
    CASE WHEN event_id % 2 = 0 THEN 'MAIN_HALL'
         ELSE 'room' || lpad(CAST((event_id // 2) % 12 AS VARCHAR), 2, '0') END AS location,
    ts AS timestamp
  FROM events""",
    "gate_events_dirty": """
  SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 23 = 0 THEN NULL ELSE student_id END AS student_id,
         event_type, gate_type, location, timestamp FROM gate_events
  UNION ALL
  SELECT event_id, student_id, event_type, gate_type, location, timestamp + INTERVAL 1 MINUTE
  FROM gate_events WHERE CAST(event_id AS BIGINT) % 17 = 0""",
    "gate_events_arrivals": """
  SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 23 = 0 THEN NULL ELSE student_id END AS student_id,
         event_type, gate_type, location, timestamp, CAST(event_id AS BIGINT) % 2 AS arrival FROM gate_events
  UNION ALL
  SELECT event_id, student_id, event_type, gate_type, location, timestamp + INTERVAL 1 MINUTE,
         (CAST(event_id AS BIGINT) + 1) % 2
  FROM gate_events WHERE CAST(event_id AS BIGINT) % 17 = 0""",
    "gate_events_dense": """
  SELECT event_id, CAST(CAST(student_id AS BIGINT) % 5 AS VARCHAR) AS student_id, event_type, gate_type,
    CASE WHEN gate_type = 'MAIN_GATE' THEN location
         WHEN (CAST(event_id AS BIGINT) // 2) % 2 = 0 THEN 'room00' ELSE 'room01' END AS location,
    timestamp
  FROM gate_events""",
    "gate_events_hot": """
  SELECT event_id,
    CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN '0' ELSE student_id END AS student_id,
    event_type, gate_type,
    CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 AND gate_type = 'ROOM_GATE' THEN 'room00' ELSE location END AS location,
    timestamp
  FROM gate_events""",
    "gate_events_odd": """
  SELECT event_id, student_id, event_type, gate_type,
    CASE WHEN gate_type = 'ROOM_GATE' AND CAST(event_id AS BIGINT) % 19 = 0 THEN 'MAIN_HALL' ELSE location END AS location,
    CASE WHEN CAST(event_id AS BIGINT) % 47 = 0 THEN NULL ELSE timestamp END AS timestamp
  FROM gate_events""",
    "students": """
  SELECT CAST(c_custkey AS VARCHAR) AS student_id,
    CASE WHEN c_custkey % 20 = 3 THEN NULL ELSE c_mktsegment END AS major,
    CASE WHEN c_custkey % 20 = 13 THEN NULL ELSE CAST(c_nationkey % 4 + 1 AS INTEGER) END AS year_of_study,
    CASE WHEN c_acctbal >= 3000 THEN 'Undergraduate' ELSE 'Postgraduate' END AS study_level
  FROM customer""",
}
_VIEW_DEPS = {
    "gate_events": (),
    "gate_events_dirty": ("gate_events",),
    "gate_events_arrivals": ("gate_events",),
    "gate_events_dense": ("gate_events",),
    "gate_events_hot": ("gate_events",),
    "gate_events_odd": ("gate_events",),
    "students": (),
}

COPY_ORDER_SQL = (
    "timestamp ASC NULLS LAST, student_id ASC NULLS LAST, event_type ASC NULLS LAST, "
    "gate_type ASC NULLS LAST, location ASC NULLS LAST"
)


def clean_full_cte(src: str, as_of: str) -> str:
    return f"""
  SELECT event_id, student_id, event_type, gate_type, location, timestamp, record_date FROM (
    SELECT *, CAST(timestamp AS DATE) AS record_date,
           row_number() OVER (PARTITION BY event_id ORDER BY {COPY_ORDER_SQL}) AS _copy
    FROM {src} WHERE student_id IS NOT NULL AND timestamp <= TIMESTAMP '{as_of}') WHERE _copy = 1"""


def latest_cte(src: str) -> str:
    return f"""
  SELECT *, CAST(timestamp AS DATE) AS record_date FROM {src}
  WHERE CAST(timestamp AS DATE) = (SELECT max(CAST(timestamp AS DATE)) FROM {src})"""


def clean_daily_cte(latest: str) -> str:
    return f"""
  SELECT event_id, student_id, event_type, gate_type, location, timestamp, record_date FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {COPY_ORDER_SQL}) AS _copy
    FROM {latest} WHERE student_id IS NOT NULL) WHERE _copy = 1"""


def durations_cte(clean: str) -> str:
    return f"""
  SELECT record_date, location AS room_id, student_id, timestamp AS entry_time, exit_timestamp AS exit_time,
         round(date_diff('second', timestamp, exit_timestamp) / 60e0, 2) AS occupied_minutes
  FROM (SELECT *, lead(timestamp) OVER w AS exit_timestamp, lead(event_type) OVER w AS next_event
        FROM {clean} WHERE gate_type = 'ROOM_GATE'
        WINDOW w AS (PARTITION BY student_id, location ORDER BY timestamp ASC NULLS LAST, event_id ASC NULLS LAST))
  WHERE event_type = 'ENTRY' AND next_event = 'EXIT'"""


def with_views(ctes: list[tuple[str, str]], body: str) -> str:
    """Prefix ``body`` with the fixture views it needs and the given extra CTEs."""
    text = body + " ".join(c for _, c in ctes)
    needed: list[str] = []

    def need(name: str) -> None:
        for dep in _VIEW_DEPS[name]:
            need(dep)
        if name not in needed:
            needed.append(name)

    for name in VIEWS:
        if name in text:
            need(name)
    parts = [f"{name} AS ({VIEWS[name]})" for name in needed]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# The period bounds and labels of the original, repeated so that the SQL stands alone.
def period_sql(ts: str) -> str:
    h = f"hour({ts} + INTERVAL 8 HOUR)"
    return (
        f"CASE WHEN {h} BETWEEN 6 AND 11 THEN 'Morning' WHEN {h} BETWEEN 12 AND 16 THEN 'Afternoon' "
        f"WHEN {h} BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END"
    )
