"""Readers and writers (CSV with explicit schema, Parquet, JSON reports, run-record tables)."""
