"""Incremental ingestion of daily files."""
