"""Continuous file ingest with Structured Streaming."""

from .ingest import ingest_batch, start_stream_ingest, stream_lines

__all__ = ["ingest_batch", "start_stream_ingest", "stream_lines"]
