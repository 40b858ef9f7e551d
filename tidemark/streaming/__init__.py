"""Structured Streaming versions of the ingest and the live figures."""
