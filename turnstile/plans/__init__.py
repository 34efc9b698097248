"""Batch jobs and the registered query catalogue."""
