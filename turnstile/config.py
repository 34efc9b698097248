"""Job settings: plain paths and names, no credentials."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from turnstile.schema import TOPIC_MAIN_GATE, TOPIC_ROOM_GATE


@dataclass(frozen=True)
class Settings:
    """All locations under one root by default; each can be set on its own."""

    root: str
    kafka_servers: str = "localhost:9092"
    topics: tuple[str, ...] = (TOPIC_MAIN_GATE, TOPIC_ROOM_GATE)
    students_csv: str | None = None
    paths: dict[str, str] = field(default_factory=dict)
    # Most Kafka offsets a micro-batch takes (None: the whole backlog at once).
    max_offsets_per_trigger: int | None = 1_000_000
    # Buckets of the id indexes; fixed for the life of a lake. About (bytes of all ids) / 256 MB.
    key_buckets: int = 64

    def path(self, name: str) -> str:
        return self.paths.get(name) or os.path.join(self.root, name)

    # named locations
    @property
    def raw(self) -> str:
        return self.path("raw")

    @property
    def curated(self) -> str:
        return self.path("curated")

    @property
    def clean(self) -> str:
        return self.path("clean")

    @property
    def clean_daily(self) -> str:
        return self.path("clean_daily")

    @property
    def clean_keys(self) -> str:
        """Which day holds each id's kept copy."""
        return self.path("clean_keys")

    @property
    def clean_pending(self) -> str:
        """Rows stamped later than the run that saw them."""
        return self.path("clean_pending")

    @property
    def rejects(self) -> str:
        """Payloads that gave no event, with the reason."""
        return self.path("rejects")

    @property
    def students_rejects(self) -> str:
        return self.path("students_rejects")

    @property
    def compacted(self) -> str:
        """Closed days of the curated table in few files."""
        return self.path("curated_compacted")

    @property
    def stays(self) -> str:
        """Stays by the day on which they end."""
        return self.path("stays")

    @property
    def open_entries(self) -> str:
        """Entries open at the end of each day."""
        return self.path("open_entries")

    @property
    def student_numbers(self) -> str:
        return self.path("student_numbers")

    @property
    def visits_daily(self) -> str:
        return self.path("visits_daily")

    @property
    def students(self) -> str:
        return self.path("students")

    def report(self, name: str) -> str:
        return self.path(os.path.join("reports", name))

    def graph(self, name: str) -> str:
        return self.path(os.path.join("graph", name))

    def checkpoint(self, name: str) -> str:
        return self.path(os.path.join("checkpoints", name))


REPORTS = ("hourly_traffic", "daily_rooms", "hourly_room_usage", "room_durations")
