"""Structured Streaming forms of the reference's chunked extract loops."""

from cohortkit.streaming.incremental import append_filtered, filtered_stream

__all__ = ["append_filtered", "filtered_stream"]
