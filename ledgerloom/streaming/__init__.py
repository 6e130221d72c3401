"""Structured Streaming forms of the feeds: ingestion, refreshed tables, daily totals."""
