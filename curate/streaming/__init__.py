"""Incremental (Structured Streaming) curation of arriving raw files."""

from curate.streaming.incremental import (curated_stream, raw_stream, read_batch_log,
                                          read_curated, start_curation)

__all__ = ["curated_stream", "raw_stream", "read_batch_log", "read_curated", "start_curation"]
