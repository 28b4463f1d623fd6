"""Structural-monitoring analytics on Spark: ingest, weekly tables, report queries.

Every public function takes and returns Spark DataFrames and stays lazy; the
only functions that start a job are the ones that write.
"""

__version__ = "0.1.0"
