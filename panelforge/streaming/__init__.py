"""Structured Streaming jobs (incremental ingest, event-log roll-up)."""
