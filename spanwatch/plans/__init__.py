"""Whole jobs: weekly ingest, weekly report, and the queries over the given tables."""
