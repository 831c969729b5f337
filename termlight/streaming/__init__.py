"""Structured Streaming ingest with the batch operators."""
