"""Incremental ingest of landed raw files into the bronze layer (Structured Streaming)."""

from kpiloom.streaming.ingest import ingest_available, start_ingest

__all__ = ["ingest_available", "start_ingest"]
