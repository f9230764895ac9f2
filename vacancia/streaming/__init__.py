"""Structured Streaming variant of the ingest path."""
