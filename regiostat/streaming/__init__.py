"""Incremental ingestion with Structured Streaming (O-19)."""
