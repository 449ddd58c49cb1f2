"""Incremental ingest on Structured Streaming."""
