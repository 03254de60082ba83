"""Batch analytics over trip records, written for Spark's DataFrame API."""
