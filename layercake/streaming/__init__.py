"""Incremental loading as a stream of files."""

from layercake.streaming.upserts import file_stream, upsert_stream

__all__ = ["file_stream", "upsert_stream"]
