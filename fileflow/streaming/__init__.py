"""Incremental ingest with the Structured Streaming file source."""

from fileflow.streaming.ingest import ingest_new_files  # noqa: F401
