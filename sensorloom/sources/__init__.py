"""Readers and writers: telemetry tables, CSV, JSON feeds and model tables."""
