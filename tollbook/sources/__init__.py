"""Scans of record files, Parquet folders and database tables."""
