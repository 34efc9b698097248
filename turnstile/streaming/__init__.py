"""Structured Streaming ingest."""

from turnstile.streaming.ingest import (
    curated_query,
    graph_upsert,
    raw_query,
    rejects_query,
    run_stream,
    start_ingest,
    upsert_query,
)

__all__ = ["curated_query", "graph_upsert", "raw_query", "rejects_query", "run_stream", "start_ingest", "upsert_query"]
