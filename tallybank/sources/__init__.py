"""Readers: delimited files, Parquet tables and streams."""
