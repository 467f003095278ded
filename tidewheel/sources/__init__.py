"""Readers and writers: CSV, Parquet tables, exports, lookups and run records."""
