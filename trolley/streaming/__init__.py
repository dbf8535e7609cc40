"""Incremental ingest of a landing directory with Structured Streaming."""
