"""Structured Streaming form of the event preparation."""

from .ingest import clean_event_stream, hourly_mean_stream, read_event_stream, run_available

__all__ = ["clean_event_stream", "hourly_mean_stream", "read_event_stream", "run_available"]
