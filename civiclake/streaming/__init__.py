"""Structured Streaming: incremental ingest of landed pages."""

from civiclake.streaming.incremental import compact, ingest_new, refresh, start_ingest, stream_records, upsert  # noqa: F401
