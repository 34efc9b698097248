"""DataFrame -> DataFrame operators (the public API, re-exported here)."""

from turnstile.operators.analytics import (
    daily_visits_by_period,
    peak_hours,
    popular_rooms,
    room_popularity_by_group,
    top_rooms_by_major_year,
    visit_summary,
    visits_by_period_major_year,
)
from turnstile.operators.graph import (
    e_at_library,
    e_entered,
    e_in_room,
    e_performed,
    e_studied_in,
    graph_tables,
    students_dim,
    v_event,
    v_library,
    v_room,
    v_student,
)
from turnstile.operators.ingest import parse_events, route_events, to_json_value
from turnstile.operators.pairing import pair_entries
from turnstile.operators.quality import (
    clean_events,
    clean_events_daily,
    clean_events_full,
    dedupe_events,
    latest_day,
    with_record_date,
)
from turnstile.operators.reports import (
    daily_room_usage,
    hourly_gate_traffic_daily,
    hourly_gate_traffic_full,
    hourly_room_usage_daily,
    hourly_room_usage_full,
    room_durations,
)

__all__ = [
    "clean_events",
    "clean_events_daily",
    "clean_events_full",
    "daily_room_usage",
    "daily_visits_by_period",
    "dedupe_events",
    "e_at_library",
    "e_entered",
    "e_in_room",
    "e_performed",
    "e_studied_in",
    "graph_tables",
    "hourly_gate_traffic_daily",
    "hourly_gate_traffic_full",
    "hourly_room_usage_daily",
    "hourly_room_usage_full",
    "latest_day",
    "pair_entries",
    "parse_events",
    "peak_hours",
    "popular_rooms",
    "room_durations",
    "room_popularity_by_group",
    "route_events",
    "students_dim",
    "to_json_value",
    "top_rooms_by_major_year",
    "v_event",
    "v_library",
    "v_room",
    "v_student",
    "visit_summary",
    "visits_by_period_major_year",
    "with_record_date",
]
