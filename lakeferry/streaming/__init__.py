"""Incremental ingest and upsert; every batch is applied exactly once."""
