"""Incremental ingest of delimited files."""

from ebbflow.streaming.ingest import ingest_new_files, month_stream

__all__ = ["ingest_new_files", "month_stream"]
