"""Table writers."""

from turnstile.sinks.writers import preview, replace_days, write_kafka, write_report, write_table

__all__ = ["preview", "replace_days", "write_kafka", "write_report", "write_table"]
