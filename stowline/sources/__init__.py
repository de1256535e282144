"""Readers: files, text lines, Parquet and archived segments."""
