"""Structured Streaming runners over the landing folders."""

from auric.streaming.ingest import stream_ingest  # noqa: F401
