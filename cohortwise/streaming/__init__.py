"""Incremental (Structured Streaming) form of the cohort extract."""

from cohortwise.streaming.extract_stream import cohort_extract_stream, start_extract_stream

__all__ = ["cohort_extract_stream", "start_extract_stream"]
