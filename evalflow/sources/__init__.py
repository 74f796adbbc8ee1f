"""Readers: file discovery, JSON lines, Parquet tables, CSV, archives."""
