"""Scans of Parquet folders and of landed pages."""
