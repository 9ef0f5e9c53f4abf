"""Incremental lakehouse ingestion on Spark: operators, plans and file streams."""
