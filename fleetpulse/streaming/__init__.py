"""Structured Streaming forms of ingest, windows, warm-up and alert sinks."""
