"""Incremental forms of the ingest and of the binned series."""
