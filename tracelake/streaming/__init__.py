"""Exactly-once topic -> table ingestion with Structured Streaming."""

from tracelake.streaming.ingest import IngestTarget, log_view, run_ingest_once, start_ingest, write_batch

__all__ = ["IngestTarget", "log_view", "run_ingest_once", "start_ingest", "write_batch"]
