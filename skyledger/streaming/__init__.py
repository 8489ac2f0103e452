"""Structured Streaming ingest for both pipelines."""
