"""Structured Streaming form of the ingest."""

from hirelens.streaming.ingest_stream import start_ingest_stream

__all__ = ["start_ingest_stream"]
