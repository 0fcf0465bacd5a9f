"""Structured Streaming entry points (incremental scoring)."""
