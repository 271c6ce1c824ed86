"""Structured Streaming forms of ingest, dedupe, change detection and windows."""
