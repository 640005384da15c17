"""Structured Streaming forms of ingest, metrics and the acknowledgement wait."""
