"""Structured Streaming forms of ingest and burst detection."""
