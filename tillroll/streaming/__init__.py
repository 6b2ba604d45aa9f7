"""Structured Streaming jobs."""

from tillroll.streaming.ingest import ingest_statements_stream

__all__ = ["ingest_statements_stream"]
