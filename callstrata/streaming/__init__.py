"""Structured Streaming forms of ingest, rollup and alerts."""
